import json
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from row_helpers import rows

from tallyhouse import schemas
from tallyhouse.plans.loads import (
    load_all_stores, load_currency, load_header, load_payment, load_payment_entry, load_sales, shape_header)
from tallyhouse.sources.extract_files import read_extract_files, write_extract_files
from tallyhouse.sources.readers import (
    empty, query_table, read_currency_sheet, read_envelopes, read_store_master, read_table, read_text_rows, require_unique,
    scan_envelopes)
from tallyhouse.sources.scratch import scratch_path
from tallyhouse.sources.writers import append, conform, named_extracts, write_duplicates, write_extracts, write_snapshot


def envelope(fields, *answers, error=False):
    full = [{field: answer.get(field) for field, _, _ in fields} for answer in answers]
    return json.dumps({"error": error, "warning": False, "result": None if error else {"rawData": full, "totalDaysInPeriod": 0},
                       "formValidationError": False})


@pytest.fixture(scope="module")
def header_rows(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("headers")
    order = {"UniqOrderId.Id": "o1", "Department": "s", "OpenDate.Typed": "2022-06-20", "OrderNum": 3837, "DishSumInt": 67.5}
    fields = schemas.HEADER_FIELDS
    (folder / "a.json").write_text(envelope(fields, order, {**order, "UniqOrderId.Id": "o2", "OpenDate.Typed": "soon", "DishSumInt": 128}))
    (folder / "b.json").write_text(envelope(fields))
    (folder / "c.json").write_text(envelope(fields, error=True))
    return read_envelopes(spark, str(folder), schemas.report_rows(fields))


def test_envelopes_in_error_or_empty_give_no_rows(header_rows):
    assert header_rows.count() == 2
    assert header_rows.columns == [field for field, _, _ in schemas.HEADER_FIELDS]


def test_broken_answers_are_kept_as_rejects(spark, tmp_path):
    fields = schemas.PAYMENT_ENTRY_FIELDS
    good = envelope(fields, {"OrderNum": 1})
    for name, text in (("a", good), ("b", good[:30]), ("c", envelope(fields, error=True)), ("d", good.replace('"error"', '"fault"'))):
        (tmp_path / f"{name}.json").write_text(text)
    scanned = scan_envelopes(spark, str(tmp_path), schemas.report_rows(fields))
    assert scanned.rows.count() == 1
    assert rows(scanned.rejects.select("file", "reason")) == [("b.json", "broken"), ("c.json", "error"), ("d.json", "neither")]


def test_text_survives_the_csv_sink(spark, tmp_path):
    texts = ["  pad ", "a\nb", "c\r\nd", 'say "hi", twice', "back\\slash \\n", "", "\t", '"', "\\", "a\0b", "\0", "\\\\\n\\", "\\\r\\\\n"]
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "i int, t string, n string")
    write_duplicates(df, str(tmp_path / "out"))
    assert rows(read_text_rows(spark, str(tmp_path / "out"), df.schema)) == rows(df.fillna(""))


def test_header_load(spark, header_rows):
    stored = empty(spark, schemas.RAW_HEADER)
    new = load_header(header_rows, stored, F.lit("4374"))
    assert new.schema.names == schemas.RAW_HEADER.names
    got = new.orderBy("uniqueOrderId").collect()
    assert [(r.storeID, r.accountingDay, r.GrossSalesBD, r.transformFlag, r.deliverySource, r.AvgCookingTime) for r in got] == [
        ("4374", date(2022, 6, 20), Decimal("67.5000"), False, "", None), ("4374", None, Decimal("128.0000"), False, "", None)]
    assert load_header(header_rows, new, F.lit("4374")).count() == 0
    assert load_header(header_rows, new, F.lit("4375")).count() == 2
    enriched = new.withColumn("transformFlag", F.lit(True))
    assert load_header(header_rows, enriched, F.lit("4374")).count() == 0
    assert load_header(header_rows, enriched, F.lit("4374"), untransformed_only=True).count() == 2
    twice = header_rows.unionAll(header_rows)
    assert load_header(twice, stored, F.lit("4374")).count() == 4
    assert load_header(twice, stored, F.lit("4374"), once=True).count() == 2


def report(spark, fields, *answers):
    text = [(json.dumps({field: a.get(field) for field, _, _ in fields}),) for a in answers]
    lines = spark.createDataFrame(text, "v string")
    return lines.select(F.from_json("v", schemas.report_rows(fields)).alias("r")).select("r.*")


def test_payment_load_keys(spark):
    answers = [{"UniqOrderId.Id": "o1", "PayTypes": "Card"}, {"UniqOrderId.Id": "o1", "PayTypes": None}]
    batch = report(spark, schemas.PAYMENT_FIELDS, *answers)
    new = load_payment(batch, empty(spark, schemas.RAW_PAYMENT))
    assert rows(new.select("uid", "paymentType")) == [("", ""), ("o1-Card", "Card")]
    # A blank key is no key: such a row is never taken for one that is stored.
    assert rows(load_payment(batch, new).select("uid")) == [("",)]
    assert load_payment(batch, new, blank_is_new=False).count() == 0


def test_sales_load_drops_the_whole_known_order(spark):
    batch = report(spark, schemas.SALES_FIELDS, {"UniqOrderId.Id": "o1", "DishName": "x"}, {"UniqOrderId.Id": "o1", "DishName": "late"},
                   {"UniqOrderId.Id": "o2", "DishName": "x"})
    stored = load_sales(batch.filter("DishName = 'x' AND `UniqOrderId.Id` = 'o1'"), empty(spark, schemas.RAW_SALES))
    assert rows(load_sales(batch, stored).select("uniqueOrderId", "item")) == [("o2", "x")]


def test_payment_entry_load_splits_the_batch(spark):
    fields = schemas.PAYMENT_ENTRY_FIELDS
    batch = report(spark, fields, *[{"UniqOrderId.Id": o, "PayTypes": "Card", "OrderNum": 1} for o in ("a", "b", "b")])
    stored = load_payment_entry(batch.filter("`UniqOrderId.Id` = 'a'"), empty(spark, schemas.PAYMENT_ENTRY), F.lit(4377)).new
    load = load_payment_entry(batch, stored, F.lit(4377))
    assert load.new.schema.names == schemas.PAYMENT_ENTRY.names
    assert rows(load.new.select("uid", "storeID")) == [("b-Card", "4377")] * 2
    assert rows(load.duplicates.select("uid", "storedCopies")) == [("a-Card", 1)]


def test_all_stores_at_once(spark):
    answers = [{"UniqOrderId.Id": f"{day}", "OpenDate.Typed": f"2022-06-{day}"} for day in (10, 18, 19, 20, 21)]
    batch = report(spark, schemas.HEADER_FIELDS, *answers)
    stored = shape_header(batch.filter("`UniqOrderId.Id` = '18'"), F.lit("1"))
    marks = spark.createDataFrame([("1", date(2022, 6, 17))], "storeID string, maxDate date")
    new = load_all_stores(batch, stored, marks, date(2022, 6, 20), 5, F.lit("1"))
    assert [r[0] for r in rows(new.select("uniqueOrderId"))] == ["19", "20"]


def test_store_master_with_byte_order_mark(spark, tmp_path):
    (tmp_path / "v3.csv").write_text("﻿StoreId,StoreCode,Folder\n0437,YO,GG\n5454,PX,KF\n", encoding="utf-8")
    assert rows(read_store_master(spark, str(tmp_path / "v3.csv"))) == [("0437", "YO", "GG"), ("5454", "PX", "KF")]
    (tmp_path / "v2.csv").write_text("﻿StoreId,StoreCode,Concept,Folder\n1,A,x,F\n1,A,w,F\n2,B,x,G\n", encoding="utf-8")
    stores = read_store_master(spark, str(tmp_path / "v2.csv"), schemas.STORE_MASTER_CONCEPTS)
    with pytest.raises(ValueError, match="stores"):
        require_unique({"stores": (stores, ["StoreId"])})
    require_unique({"stores": (stores, ["StoreId", "Concept"])})


def test_currency_sheet(spark, tmp_path):
    path = tmp_path / "fx.csv"
    path.write_text("transHeader Value (Region),CurrencyConvFactor\nUAE,1\nQATAR,1.00890001\n,\nOMAN,n/a\n")
    currency = load_currency(read_currency_sheet(spark, str(path)))
    assert rows(currency) == [("", None), ("OMAN", None), ("QATAR", Decimal("1.00890001")), ("UAE", Decimal("1.00000000"))]


def test_tables_are_written_by_name(spark, tmp_path):
    path = str(tmp_path / "currency")
    append(spark.createDataFrame([(2.0, "b")], "factor double, region string"), path, schemas.CURRENCY, ["region"])
    append(spark.createDataFrame([("a", 1.5)], "region string, factor double"), path, schemas.CURRENCY, ["region"])
    table = read_table(spark, path, schemas.CURRENCY)
    assert rows(table.select("region", "factor")) == [("a", Decimal("1.50000000")), ("b", Decimal("2.00000000"))]
    assert rows(query_table(spark, table, "SELECT region FROM {table} WHERE region = :r", r="b")) == [("b",)]
    with pytest.raises(ValueError):
        conform(table.drop("factor"), schemas.CURRENCY)
    with pytest.raises(Exception, match="(?i)exists"):
        write_snapshot(table, path)


def test_extract_folders(spark, tmp_path):
    data = spark.createDataFrame([("1", "A", "x"), ("1", "B", "y"), ("2", "A", "z"), ("9", "A", "lost")], "storeID string, conception string, v string")
    stores = spark.createDataFrame([("1", "ONE", "A", "F1"), ("1", "ONE", "B", "F2"), ("2", "TWO", "A", "F1")], schemas.STORE_MASTER_CONCEPTS)
    extracts = named_extracts(data, stores, date(2022, 6, 20), date(2022, 6, 20))
    for form in ("csv", "json"):
        out = tmp_path / form
        write_extracts(extracts, str(out), form)
        assert sorted(str(p.relative_to(out)) for p in out.glob("*/*") if p.is_dir()) == [
            "Folder=F1/Extract=PaymentEntry_1_ONE_A_2022-06-20_2022-06-20", "Folder=F1/Extract=PaymentEntry_2_TWO_A_2022-06-20_2022-06-20",
            "Folder=F2/Extract=PaymentEntry_1_ONE_B_2022-06-20_2022-06-20"]
        reader = spark.read.option("header", True)
        assert getattr(reader, form)(str(out)).count() == 3
    with pytest.raises(ValueError):
        write_extracts(extracts, str(tmp_path / "x"), "xml")


@pytest.mark.parametrize("form", ["csv", "json"])
def test_extract_files_have_their_names(spark, tmp_path, form):
    lines = [("1", "SaladBar", f"hot\n{i}") for i in range(25)] + [("1", "Noodle House", "a"), ("2", "SaladBar", "b"), ("9", "SaladBar", "lost")]
    data = spark.createDataFrame(lines, "storeID string, conception string, v string").repartition(3)
    stores = spark.createDataFrame([("1", "ONE", "SaladBar", "GG"), ("1", "ONE", "Noodle House", "MAIN ST+1"), ("2", "TWO", "SaladBar", "GG")],
                                   schemas.STORE_MASTER_CONCEPTS)
    extracts = named_extracts(data, stores, date(2022, 6, 20), date(2022, 6, 20))
    path = str(tmp_path / "out")
    names = write_extract_files(extracts, path, form, file_rows=10)
    end = "2022-06-20_2022-06-20"
    hot = [n for n in names if "PaymentEntry_1_ONE_SaladBar" in n]
    assert hot[0] == f"GG/PaymentEntry_1_ONE_SaladBar_{end}.{form}" and f"GG/PaymentEntry_1_ONE_SaladBar_{end}_2.{form}" in hot and len(hot) >= 3
    assert sorted(set(names) - set(hot)) == [f"GG/PaymentEntry_2_TWO_SaladBar_{end}.{form}", f"MAIN ST+1/PaymentEntry_1_ONE_Noodle House_{end}.{form}"]
    assert sorted(str(p.relative_to(path)) for p in (tmp_path / "out").rglob(f"*.{form}") if not p.name.startswith(".")) == names
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
    back = read_extract_files(spark, path, data.schema, form)
    assert rows(back.select("storeID", "conception", "v")) == sorted(lines[:-1])
    assert rows(back.filter("v = 'a'").select("Folder", "File")) == [("MAIN ST+1", f"PaymentEntry_1_ONE_Noodle House_{end}.{form}")]
    with pytest.raises(FileExistsError):
        write_extract_files(extracts, path, form)
    with pytest.raises(ValueError):
        write_extract_files(extracts, path, "xml")


def test_scratch_is_in_the_shared_folder(spark):
    path = scratch_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir")) and path != scratch_path(spark, "x")
