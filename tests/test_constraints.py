import json

from pyspark.sql import functions as F

from tallyframe.operators import constraints as C
from tallyframe.operators.profile import ProfileOptions, profile
from tallyframe.plans.constraint_plans import LINES_STRICT, LINES_LOOSE

LI = "/root/testdata/sf0.001/lineitem.parquet"


def test_both_key_spellings():
    a = C.parse_constraints({"summaryConstraints": {"x": {"constraints": [
        {"first_field": "min", "op": "GE", "value": 0}]}}})
    b = C.parse_constraints(json.dumps({"summaryConstraints": {"x": {"constraints": [
        {"firstField": "min", "op": "GE", "value": 0}]}}}))
    assert a == b and a[0].label == "summary min GE 0"


def test_op_rules_not_name():
    c = [x for x in C.parse_constraints(LINES_STRICT) if x.name == "taxed lines"][0]
    assert (c.column, c.op) == ("l_tax", "LT")


def test_fail_and_succeed_files(spark, tmp_path):
    li = spark.read.parquet(LI)
    p = profile(li, "li", options=ProfileOptions(sketches=False))
    f = tmp_path / "fail.json"
    f.write_text(json.dumps(LINES_STRICT))
    fail = C.verdict(C.report(li, p, C.parse_constraints(str(f))), expect_failure=True).first()
    ok = C.verdict(C.report(li, p, C.parse_constraints(LINES_LOOSE))).first()
    assert fail["passed"] is False and fail["action_ok"] is True
    assert ok["passed"] is True and ok["action_ok"] is True


def test_pass_plus_fail_is_non_null(spark):
    li = spark.read.parquet(LI).withColumn("l_discount", F.expr("nullif(l_discount, 0.05)"))
    cs = C.parse_constraints({"valueConstraints": {"l_discount": {"constraints": [
        {"op": "GT", "value": 0.03}]}}})
    r = C.value_report(li, cs).first()
    passed = li.filter(F.col("l_discount") > 0.03).count()
    assert r["total"] == li.filter(F.col("l_discount").isNotNull()).count()
    assert passed + r["failures"] == r["total"]


def test_failure_messages(spark):
    li = spark.read.parquet(LI)
    f = C.failures(li, C.parse_constraints(LINES_STRICT))
    msgs = C.failure_messages(f.filter("name = 'small lots'")).limit(1).collect()
    assert msgs and msgs[0][0].startswith("l_quantity: ") and msgs[0][0].endswith(" fails small lots")


def test_inline_observation_keeps_columns_apart(spark, tmp_path):
    df = spark.createDataFrame([(1, 10), (5, 0), (7, 9)], "a int, b int")
    cs = C.parse_constraints({"valueConstraints": {
        c: {"constraints": [{"op": "LT", "value": 6}]} for c in ("a", "b")}})
    observed, obs = C.observe_failures(df, cs)
    observed.write.parquet(str(tmp_path / "out"))
    assert obs.get == {"a: value LT 6": 1, "b: value LT 6": 2}


def test_text_values_and_mixed_text_columns(spark):
    df = spark.createDataFrame([("N", "5"), ("R", "oops"), (None, "12")], "flag string, size string")
    cs = C.parse_constraints({"valueConstraints": {
        "flag": {"constraints": [{"op": "EQ", "value": "N"}]},
        "size": {"constraints": [{"op": "GT", "value": 6}]}}})
    got = {r["column"]: (r["total"], r["failures"], r["passed"]) for r in C.value_report(df, cs).collect()}
    assert got == {"flag": (2, 1, False), "size": (2, 1, False)}


def test_missing_columns_and_empty_data_fail(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    doc = {"valueConstraints": {"nope": {"constraints": [{"op": "GT", "value": 0}]}},
           "summaryConstraints": {"gone": {"constraints": [{"first_field": "min", "op": "GE", "value": 0}]}}}
    cs = C.parse_constraints(doc)
    p = profile(df, "d", options=ProfileOptions(sketches=False))
    r = C.report(df, p, cs).collect()
    assert [x["passed"] for x in r] == [False, False]
    assert C.verdict(C.report(df, p, cs)).first()["passed"] is False
    none = df.filter("a > 5")
    cs = C.parse_constraints({"valueConstraints": {"a": {"constraints": [{"op": "GT", "value": 0}]}},
                              "summaryConstraints": {"a": {"constraints": [{"first_field": "min", "op": "GE", "value": 0}]}}})
    r = C.report(none, profile(none, "d", options=ProfileOptions(sketches=False)), cs).collect()
    assert len(r) == 2 and not any(x["passed"] for x in r)


def test_grouped_report_has_the_group(spark):
    df = spark.createDataFrame([("x", 1.0), ("y", -1.0)], "g string, a double")
    p = profile(df, "d", tags=["g"], options=ProfileOptions(sketches=False))
    cs = C.parse_constraints({"summaryConstraints": {"a": {"constraints": [{"first_field": "min", "op": "GE", "value": 0}]}}})
    got = {r["tags"][0]["value"]: r["passed"] for r in C.summary_report(p, cs).collect()}
    assert got == {"x": True, "y": False}


def test_stream_report_rows_per_batch(spark, tmp_path):
    from tallyframe.streaming import constraint_stream as CS
    cs = C.parse_constraints({"valueConstraints": {"a": {"constraints": [{"name": "low", "op": "GE", "value": 0.0}]},
                                                   "t": {"constraints": [{"name": "num", "op": "GE", "value": 0.0}, {"name": "is x", "op": "NE", "value": "x"}]},
                                                   "gone": {"constraints": [{"op": "GE", "value": 0.0}]}}})
    schema = "a double, t string"
    write = CS.checked_sink_writer(cs, str(tmp_path / "rows"), str(tmp_path / "report"))
    batches = [[(1.0, "5"), (None, "abc")], [(-1.0, None), (2.0, "x")], [], [(None, None)]]
    for i, rows in enumerate(batches):
        for _ in range(2):       # a replay changes nothing
            write(spark.createDataFrame(rows, schema), i)
    report = CS.with_verdict(spark.read.parquet(str(tmp_path / "report")))
    got = {(r["batch_id"], r["name"]): (r["rows"], r["total"], r["failures"], r["not_comparable"], r["passed"]) for r in report.collect()}
    assert got[0, "low"] == (2, 1, 0, 0, True) and got[1, "low"] == (2, 2, 1, 0, False)
    assert got[0, "num"] == (2, 1, 0, 1, True) and got[1, "num"] == (2, 0, 0, 1, False) and got[1, "is x"] == (2, 1, 1, 0, False)
    assert all(got[2, c.label] == (0, 0, 0, 0, None) and got[3, c.label] == (1, 0, 0, 0, False) for c in cs)
    whole = {r["name"]: r for r in CS.merge_reports(report).collect()}
    assert len(whole) == 4 and not whole["low"]["passed"] and whole["low"]["failed_batches"] == 1 and whole["low"]["batches"] == 4
    assert whole["num"]["passed"] and whole["num"]["not_comparable"] == 2 and not whole[cs[3].label]["passed"]
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 5
    one = C.value_report(spark.createDataFrame([("abc",), ("5",)], "t string"), cs[1:2]).first()
    assert (one["total"], one["not_comparable"], one["passed"]) == (1, 1, True)
