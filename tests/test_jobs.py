import contextlib
import io
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from row_helpers import left_by, rows

from tallyhouse import schemas
from tallyhouse.operators.dedupe import new_beside_buckets
from tallyhouse.operators.joins import hot_keys
from tallyhouse.operators.windows import high_water_marks
from tallyhouse.plans.jobs import TABLES, Warehouse, due_lines, enrich, load, open_orders, store_marks, unmapped
from tallyhouse.plans.loads import shape_sales
from tallyhouse.plans.transforms import Mappings, transform_sales


def report(spark, fields, answers):
    kinds = ", ".join(f"`{field}` string" for field, _, _ in fields)
    return spark.createDataFrame([tuple(a.get(field) for field, _, _ in fields) for a in answers], kinds)


def headers(spark, *orders):
    common = {"OrderDeleted": "NOT_DELETED", "Conception": "C", "Delivery.IsDelivery": "F", "OrderType": "Dine"}
    return report(spark, schemas.HEADER_FIELDS, [
        {**common, "UniqOrderId.Id": o, "Department": store, "OpenDate.Typed": day, "OrderNum": "1", "DishSumInt": "8"} for o, store, day in orders])


def payments(spark, *paid):
    return report(spark, schemas.PAYMENT_FIELDS, [
        {"UniqOrderId.Id": o, "PayTypes": kind, "OpenDate.Typed": "2022-06-20", "DishDiscountSumInt": "4"} for o, kind in paid])


def sales(spark, *sold):
    return report(spark, schemas.SALES_FIELDS, [
        {"UniqOrderId.Id": o, "DishName": dish, "DeletedWithWriteoff": "NOT_DELETED", "OpenDate.Typed": day} for o, dish, day in sold])


def mappings(spark, *stores):
    virtual = spark.createDataFrame([(s, "C", "n", "no", "v", "vn", "f", "R") for s in stores],
                                    "storeName string, conceptionName string, conceptionNo string, storeNo string, virtualStoreNo string, "
                                    "virtualStoreName string, financeStoreNo string, regionCode string")
    return Mappings.measured(virtual, spark.createDataFrame([("F", "Y")], "deliveryName string, deliveryNo string"),
                             spark.createDataFrame([("X", "Web")], "SourceKey string, RefinedOrderSource string"),
                             spark.createDataFrame([("R", Decimal("2.5"))], "region string, factor decimal(18,8)"))


def ids(warehouse, table, *columns):
    return rows(warehouse.read(table).select(*columns))


def test_late_unmapped_and_blank_rows_are_enriched_once(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    store = F.lit("9")
    # The second order has no store mapping yet, the third no date that can be read.
    first = (headers(spark, ("o1", "S", "2022-06-20"), ("o2", "T", "2022-06-20"), ("o3", "S", "soon")),
             payments(spark, ("o1", "Card"), ("o2", "Card"), ("o1", None)), sales(spark, ("o1", "tea", "2022-06-20"), ("o2", "tea", "2022-06-19")))
    load(warehouse, *first, store, "a")
    enrich(warehouse, mappings(spark, "S"), "a")
    assert ids(warehouse, "transformHeader", "uniqueOrderId") == [("o1",), ("o3",)]
    assert ids(warehouse, "transformPayment", "uniqueOrderId", "paymentType") == [("o1", ""), ("o1", "Card")]
    assert ids(warehouse, "unmappedHeader", "uniqueOrderId", "lacks", "run") == [("o2", "store", "a")]
    # The same batch again changes nothing.
    before = {table: warehouse.read(table).count() for table in TABLES if table != "unmappedHeader"}
    load(warehouse, *first, store, "a")
    enrich(warehouse, mappings(spark, "S"), "a again")
    assert {table: warehouse.read(table).count() for table in before} == before
    # A payment that comes late for an enriched order, an older day, and the mapping that was missing.
    load(warehouse, headers(spark, ("o4", "S", "2022-06-01")), payments(spark, ("o1", "Voucher"), ("o1", "Card"), ("o4", "Card")),
         sales(spark, ("o4", "cake", "2022-05-31")), store, "b")
    enrich(warehouse, mappings(spark, "S", "T"), "b")
    assert ids(warehouse, "transformHeader", "uniqueOrderId") == [("o1",), ("o2",), ("o3",), ("o4",)]
    assert ids(warehouse, "transformPayment", "uniqueOrderId", "paymentType", "grossSalesAD_BC") == [
        (o, p, Decimal("10.0000")) for o, p in (("o1", ""), ("o1", "Card"), ("o1", "Voucher"), ("o2", "Card"), ("o4", "Card"))]
    assert ids(warehouse, "transformSales", "uniqueOrderId", "itemName", "businessMonth") == [
        ("o1", "tea", "2022-06"), ("o2", "tea", "2022-06"), ("o4", "cake", "2022-05")]
    enrich(warehouse, mappings(spark, "S", "T"), "c")
    assert warehouse.read("transformPayment").count() == 5


@pytest.mark.parametrize("hot_rows", [1, 10])
def test_hot_orders_change_no_row(spark, tmp_path, hot_rows):
    warehouse = Warehouse(spark, str(tmp_path))
    lines = sales(spark, *[("o1", f"d{i % 4}", "2022-06-20") for i in range(40)], ("o2", "x", "2022-06-20"))
    load(warehouse, headers(spark, ("o1", "S", "2022-06-20"), ("o2", "S", "2022-06-20")), payments(spark, ("o1", "Card")), lines, F.lit("9"), "a", hot_rows=hot_rows)
    enrich(warehouse, mappings(spark, "S"), "a", hot_rows=hot_rows)
    assert warehouse.read("transformSales").count() == 41
    assert warehouse.read("transformHeader").select("fk_rawHeader").distinct().count() == 2


DAY = "2022-06-20"


def delivery(spark, *orders):
    return (headers(spark, *((o, "S", DAY) for o in orders)), payments(spark, *((o, "Card") for o in orders)),
            sales(spark, *((o, dish, DAY) for o in orders for dish in ("tea", "cake"))))


def shown(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("extended")
    return out.getvalue()


def test_a_second_delivery_under_a_label_brings_what_it_has_beyond_the_first(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    load(warehouse, *delivery(spark, "o1"), F.lit("9"), "a")
    load(warehouse, *delivery(spark, "o1", "o2"), F.lit("9"), "a")
    load(warehouse, *delivery(spark, "o2", "o1"), F.lit("9"), "a")
    assert ids(warehouse, "rawHeader", "uniqueOrderId") == [("o1",), ("o2",)]
    assert ids(warehouse, "rawPayment", "uid") == [("o1-Card",), ("o2-Card",)]
    assert ids(warehouse, "rawSales", "uniqueOrderId", "item") == [(o, d) for o in ("o1", "o2") for d in ("cake", "tea")]
    assert rows(warehouse.history().filter("table LIKE 'raw%'").drop("step")) == [
        (n, "a", table, count) for n in (1, 2) for table, count in (("rawHeader", 1), ("rawPayment", 1), ("rawSales", 2))]


def test_payments_without_a_key_are_told_by_label_and_content(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    for label, expected in (("a", 1), ("a", 1), ("b", 2)):
        load(warehouse, None, payments(spark, ("o1", None)), None, F.lit("9"), label)
        assert warehouse.read("rawPayment").count() == expected


def test_the_older_payment_table(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    entries = report(spark, schemas.PAYMENT_ENTRY_FIELDS, [{"UniqOrderId.Id": o, "PayTypes": "Card", "Department": "S"} for o in ("o1", "o2")])
    for _ in range(2):
        load(warehouse, None, None, None, F.lit("9"), "a", entries, F.col("Department"))
    assert ids(warehouse, "paymentEntry", "uid", "storeID") == [("o1-Card", "S"), ("o2-Card", "S")]


@pytest.mark.parametrize("dies_at", ["rawSales", "rawHeader", "ledger"])
def test_a_load_that_died_left_nothing_and_runs_again(spark, tmp_path, monkeypatch, dies_at):
    first = Warehouse(spark, str(tmp_path))
    load(first, *delivery(spark, "o1"), F.lit("9"), "a")
    write, record = Warehouse._write, Warehouse._record

    def half_written(self, table, batch, name):
        if table == dies_at:
            write(self, table, batch.limit(1), name)
            raise OSError("lost")
        return write(self, table, batch, name)

    def not_recorded(self, commit):
        raise OSError("lost")

    monkeypatch.setattr(Warehouse, "_write", half_written)
    if dies_at == "ledger":
        monkeypatch.setattr(Warehouse, "_record", not_recorded)
    with pytest.raises(OSError):
        load(first, *delivery(spark, "o1", "o2"), F.lit("9"), "b")
    monkeypatch.setattr(Warehouse, "_write", write)
    monkeypatch.setattr(Warehouse, "_record", record)
    for warehouse in (first, Warehouse(spark, str(tmp_path))):  # the same session, and one that starts anew
        assert ids(warehouse, "rawHeader", "uniqueOrderId") == [("o1",)]
        assert warehouse.read("rawSales").count() == 2
    again = Warehouse(spark, str(tmp_path))
    load(again, *delivery(spark, "o1", "o2"), F.lit("9"), "b")
    for warehouse in (again, Warehouse(spark, str(tmp_path))):
        assert ids(warehouse, "rawHeader", "uniqueOrderId") == [("o1",), ("o2",)]
        assert ids(warehouse, "rawPayment", "uid") == [("o1-Card",), ("o2-Card",)]
        assert warehouse.read("rawSales").count() == warehouse.read("rawSales", bucketed=False).count() == 4


def test_an_enrichment_that_died_enriches_each_row_once(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    load(warehouse, *delivery(spark, "o1", "o2"), F.lit("9"), "a")
    write = Warehouse._write

    def half_written(self, table, batch, name):
        if table == "transformSales":
            write(self, table, batch.limit(2), name)
            raise OSError("lost")
        return write(self, table, batch, name)

    monkeypatch.setattr(Warehouse, "_write", half_written)
    with pytest.raises(OSError):
        enrich(warehouse, mappings(spark, "S"), "a")
    monkeypatch.setattr(Warehouse, "_write", write)
    warehouse = Warehouse(spark, str(tmp_path))
    enrich(warehouse, mappings(spark, "S"), "again")
    assert ids(warehouse, "transformHeader", "uniqueOrderId") == [("o1",), ("o2",)]
    assert ids(warehouse, "transformPayment", "uniqueOrderId") == [("o1",), ("o2",)]
    assert ids(warehouse, "transformSales", "uniqueOrderId", "itemName") == [(o, d) for o in ("o1", "o2") for d in ("cake", "tea")]


def test_a_run_reads_no_finished_commit(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    both, late = delivery(spark, "o1", "o2"), delivery(spark, "o3")
    load(warehouse, *both, F.lit("9"), "a")
    load(warehouse, None, late[1], late[2], F.lit("9"), "b")  # its header comes later
    enrich(warehouse, mappings(spark, "S"), "first")
    assert rows(open_orders(warehouse, "sales")) == [("o3", warehouse.of_table("rawSales")[1])]
    reads, read = [], Warehouse.read
    monkeypatch.setattr(Warehouse, "read", lambda self, table, commits=None, bucketed=True: reads.append((table, commits)) or read(self, table, commits, bucketed))
    enrich(warehouse, mappings(spark, "S"), "second")
    assert reads == []
    load(warehouse, late[0], None, None, F.lit("9"), "c")
    reads.clear()
    enrich(warehouse, mappings(spark, "S"), "third")
    finished, waiting = warehouse.of_table("rawSales")
    assert {c for table, commits in reads if table in ("rawSales", "rawPayment") for c in commits or ["all"]} == {waiting}
    due = spark.createDataFrame([("o3", waiting)], "uniqueOrderId string, loadCommit string")
    plan = shown(due_lines(warehouse, "rawSales", due))
    assert "PartitionFilters: [isnotnull(commit#" in plan and finished not in plan and waiting in plan
    assert ids(warehouse, "transformSales", "uniqueOrderId", "itemName") == [(o, d) for o in ("o1", "o2", "o3") for d in ("cake", "tea")]
    assert rows(open_orders(warehouse, "sales")) == rows(open_orders(warehouse, "payment")) == []


def test_lines_and_stored_keys_stay_in_their_buckets(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path), buckets=6)
    load(warehouse, *delivery(spark, "o1", "o2"), F.lit("9"), "a")
    enrich(warehouse, mappings(spark, "S"), "a")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = warehouse.read("rawSales").withColumnRenamed("commit", "loadCommit")
        enriched = shown(transform_sales(lines, warehouse.read("transformHeader"), mappings(spark, "S"))).split("== Physical Plan ==")[1]
        assert "Exchange hashpartitioning" not in enriched and enriched.count("Bucketed: true") == 2
        batch = shape_sales(delivery(spark, "o2", "o3")[2])
        for hot in ((), hot_keys(batch, ["uniqueOrderId"], 1)):
            new = new_beside_buckets(batch, warehouse.read("rawSales"), "uniqueOrderId", hot)
            plan = shown(new).split("== Physical Plan ==")[1]
            # Only the batch is moved.
            assert plan.count("Exchange hashpartitioning(uniqueOrderId") == 1 and "Bucketed: true" in plan
            assert [r.uniqueOrderId for r in new.collect()] == ["o3", "o3"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert Warehouse(spark, str(tmp_path), buckets=3).buckets == 6


def test_disjoint_deliveries_read_no_stored_rows(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    load(warehouse, *delivery(spark, "a1", "a9"), F.lit("9"), "a")
    reads, read = [], Warehouse.read
    monkeypatch.setattr(Warehouse, "read", lambda self, table, commits=None, bucketed=True: reads.extend(commits or ()) or read(self, table, commits, bucketed))
    load(warehouse, *delivery(spark, "b1", "b9"), F.lit("9"), "b")
    assert reads == []
    load(warehouse, *delivery(spark, "a5", "a9"), F.lit("9"), "c")  # inside the first one's range
    assert set(reads) == {warehouse.of_table("rawHeader")[0]}
    assert ids(warehouse, "rawHeader", "uniqueOrderId") == [(o,) for o in ("a1", "a5", "a9", "b1", "b9")]


def test_orders_are_tried_again_only_when_mappings_change(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    load(warehouse, headers(spark, ("o1", "T", DAY), ("o2", "U", DAY)), None, None, F.lit("9"), "a")
    enrich(warehouse, mappings(spark, "S"), "first")
    commits = len(warehouse.commits)
    enrich(warehouse, mappings(spark, "S"), "second")
    assert len(warehouse.commits) == commits
    enrich(warehouse, mappings(spark, "S", "T"), "third")
    assert ids(warehouse, "transformHeader", "uniqueOrderId") == [("o1",)]
    assert rows(unmapped(warehouse).select("uniqueOrderId", "run")) == [("o2", "third")]
    enrich(warehouse, mappings(spark, "U", "T", "S"), "fourth")
    assert rows(unmapped(warehouse)) == [] and ids(warehouse, "transformHeader", "uniqueOrderId") == [("o1",), ("o2",)]


def test_marks_are_folded_from_those_of_the_loads(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    for label, days in (("a", ("2022-06-19", "2022-06-21")), ("b", ("2022-06-20",))):
        load(warehouse, headers(spark, *((f"{label}{d}", "S", d) for d in days)), None, None, F.lit("9"), label)
    load(warehouse, headers(spark, ("x", "S", "2022-06-01"), ("y", "S", "soon")), None, None, F.lit("7"), "c")
    tables, read = [], Warehouse.read
    monkeypatch.setattr(Warehouse, "read", lambda self, table, commits=None, bucketed=True: tables.append(table) or read(self, table, commits, bucketed))
    marks = rows(store_marks(warehouse))
    assert marks == rows(high_water_marks(read(warehouse, "rawHeader"))) and [m[0] for m in marks] == ["7", "9"]
    assert tables == ["storeMarks"]


def test_an_empty_delivery(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    load(warehouse, *delivery(spark), F.lit("9"), "a")
    enrich(warehouse, mappings(spark, "S"), "a")
    assert all(warehouse.read(table).count() == 0 for table in TABLES)


def test_a_load_moves_no_stored_row_and_leaves_no_shuffle(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path), buckets=4)
    orders = [f"o{i}" for i in range(60)]
    load(warehouse, *delivery(spark, *orders[:55]), F.lit("9"), "a")
    plans, write = {}, Warehouse._write

    def recorded(self, table, batch, name):
        plans[table] = batch._jdf.queryExecution().executedPlan().toString()
        return write(self, table, batch, name)

    monkeypatch.setattr(Warehouse, "_write", recorded)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert left_by(spark, lambda: load(warehouse, *delivery(spark, *orders), F.lit("9"), "b")) == set()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for table in ("rawHeader", "rawSales"):
        # Stored rows are sifted out first; what is left is dealt to the buckets once, and not rebalanced again.
        assert "bitmap_construct_agg" in plans[table] and "REBALANCE" not in plans[table]
    assert ids(warehouse, "rawHeader", "uniqueOrderId") == sorted((o,) for o in orders)
    assert warehouse.read("rawSales").count() == warehouse.read("rawSales", bucketed=False).count() == 120
    assert rows(warehouse.history().filter("number = 2 AND table LIKE 'raw%'").select("table", "rows")) == [
        ("rawHeader", 5), ("rawPayment", 5), ("rawSales", 10)]
