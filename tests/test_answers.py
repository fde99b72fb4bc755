import json

import pytest
from row_helpers import rows

from tallyhouse import schemas
from tallyhouse.sources.answers import read_answers, stored_names

FIELDS = schemas.PAYMENT_ENTRY_FIELDS


def row(**more):
    full = {field: None for field, _, _ in FIELDS}
    return {**full, "OrderNum": 7, "DishDiscountSumInt": 67.5, "OpenDate.Typed": "2022-06-20", "UniqOrderId.Id": "o1", **more}


def answer(*answers, **more):
    return json.dumps({"error": False, "warning": False, "result": {"rawData": list(answers), "totalDaysInPeriod": 0}, **more})


DRIFTED = row(OrderNum="soon", Loyalty=True, **{"DishDiscountSumInt": "12.25"})
DRIFTED.pop("CreditUser")
TEXTS = {
    "a.json": answer(row(), row(OrderNum=3, DishDiscountSumInt=128)), "b.json": answer(), "c.json": answer(error=True), "d.json": answer(row())[:40],
    "e.json": json.dumps({"fault": 1}), "f.json": json.dumps({"error": False}), "g.json": json.dumps({"error": False, "result": {"rawData": 5}}),
    "h.json": answer(DRIFTED, row(**{"UniqOrderId.Id": "é\n\"x"})), "i.json": json.dumps({"error": False, "result": None}),
}


@pytest.mark.parametrize("one_per_line", [False, True])
def test_rows_rejects_and_drift(spark, tmp_path, one_per_line):
    if one_per_line:
        (tmp_path / "all.json").write_text("\n\n".join(TEXTS.values()) + "\n")
    else:
        for name, text in TEXTS.items():
            # A document may span lines.
            (tmp_path / name).write_text(text.replace('"result"', '\n  "result"') if name in "a.json h.json" else text)
    found = read_answers(spark, str(tmp_path), FIELDS, one_per_line)
    assert found.rows.columns == [field for field, _, _ in FIELDS]
    named = stored_names(found.rows, FIELDS)
    assert [(f.name, f.dataType.simpleString()) for f in named.schema] == [(n, "string" if k == "date" else k) for _, n, k in FIELDS]
    assert rows(named.selectExpr("uniqOrderId", "orderNum", "CAST(dishDiscountSumInt AS double)", "openDate")) == [
        ("o1", 3, 128.0, "2022-06-20"), ("o1", 7, 67.5, "2022-06-20"), ("o1", None, 12.25, "2022-06-20"), ("é\n\"x", 7, 67.5, "2022-06-20")]
    assert rows(found.rejects.select("reason")) == [(r,) for r in ("broken", "empty", "empty", "empty", "error", "neither")]
    if not one_per_line:
        assert rows(found.rejects.select("file", "reason")) == [
            ("c.json", "error"), ("d.json", "broken"), ("e.json", "neither"), ("f.json", "empty"), ("g.json", "empty"), ("i.json", "empty")]
    assert rows(found.drift) == [("CreditUser", "missing", 1), ("Loyalty", "unknown", 1), ("OrderNum", "misfit", 1)]


def test_rows_that_are_no_objects(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"error": false, "result": {"rawData": [1, null, {"OrderNum": 5}]}}')
    found = read_answers(spark, str(tmp_path), FIELDS)
    assert rows(stored_names(found.rows, FIELDS).select("orderNum")) == [(5,), (None,), (None,)]
    assert {(r.field, r.rows) for r in found.drift.collect()} == {("OrderNum", 2), *((f, 3) for f, _, _ in FIELDS if f != "OrderNum")}


def test_no_answers(spark, tmp_path):
    (tmp_path / "a.json").write_text("")
    found = read_answers(spark, str(tmp_path), FIELDS)
    assert [df.count() for df in found] == [0, 0, 0]
