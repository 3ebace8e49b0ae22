"""All keys of a table in one pass."""

import pytest
from pyspark.sql import functions as F

from relsync.operators.checks import (KeyViolation, Reference, check_keys, key_report, key_violations,
                                      orphan_keys)


@pytest.fixture
def child(spark):
    rows = [(i, i % 7, None if i % 5 == 0 else i % 11, f"p{i % 3}") for i in range(60)] + [(3, 3, 3, "p0"), (None, 1, 1, None)]
    return spark.createDataFrame(rows, "n long, reason int, key long, `a b` string")


def test_the_report_equals_the_single_checks(spark, child):
    parents = spark.createDataFrame([(i,) for i in range(9)] * 2, "id int")
    pairs = spark.createDataFrame([(i, f"p{i % 3}") for i in range(7)], "x long, y string")
    unique = {"pk": ["n"], "pair": ["reason", "a b"]}
    references = {"to parents": Reference(("key",), parents, ("id",)), "to pairs": Reference(("reason", "a b"), pairs, ("x", "y"))}
    got = sorted(map(tuple, key_report(child, unique, references).collect()), key=repr)
    text = lambda n: F.to_json(F.array(*[F.col(f"__{i}").cast("string") for i in range(n)]))
    want = []
    for name, cols in unique.items():
        found = key_violations(child, cols).toDF(*[f"__{i}" for i in range(len(cols))], "why", "times")
        want += [(name, r["why"], r["k"], r["times"]) for r in found.withColumn("k", text(len(cols))).collect()]
    for name, ref in references.items():
        found = orphan_keys(child, ref.parent, ref.columns, ref.parent_columns).toDF(*[f"__{i}" for i in range(len(ref.columns))], "times")
        want += [(name, "orphan", r["k"], r["times"]) for r in found.withColumn("k", text(len(ref.columns))).collect()]
    assert got == sorted(want, key=repr) and {x[1] for x in got} == {"null_key", "duplicate_key", "orphan"}


def test_one_scan_of_the_table_in_the_plan(spark, child, tmp_path):
    child.write.parquet(str(tmp_path / "child"))
    stored = spark.read.parquet(str(tmp_path / "child"))
    other = spark.range(9)
    report = key_report(stored, {"a": ["n"], "b": ["reason"]}, {
        "c": Reference(("key",), other, ("id",)), "d": Reference(("n",), other, ("id",))})
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert plan.index("HashAggregate") > 0 and plan.count("partial_count") == 1


def test_values_of_another_type_than_the_parents(spark):
    child = spark.createDataFrame([("1",), ("2",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([(1,)], "id long")
    got = {r["key"] for r in key_report(child, {}, {"c": Reference(("k",), parent, ("id",))}).collect()}
    assert got == {'["2"]', '["x"]'}


def test_bad_calls_and_clean_tables(spark, child):
    other = spark.range(100)
    for unique, references in (({}, {}), ({"a": []}, {}), ({"a": ["n"]}, {"a": Reference(("n",), other, ("id",))}),
                               ({}, {"a": Reference(("n", "key"), other, ("id",))})):
        with pytest.raises(ValueError):
            key_report(child, unique, references)
    check_keys(child, {}, {})
    check_keys(other, {"a": ["id"]}, {"b": Reference(("id",), other, ("id",))})
    assert key_report(child.limit(0), {"a": ["n"]}, {}).count() == 0
    with pytest.raises(KeyViolation, match="b: orphan"):
        check_keys(other, {}, {"b": Reference(("id",), other.where("id <> 7"), ("id",))})


def test_numbers_are_counted_evenly_dealt_and_without_join(spark, tmp_path):
    spark.range(1000).selectExpr("id % 100 k", "cast(id % 7 as int) m", "id n").write.parquet(str(tmp_path / "child"))
    child = spark.read.parquet(str(tmp_path / "child"))
    parent = spark.range(1000).selectExpr("cast(id % 50 as int) p")
    report = key_report(child, {"a": ["k", "m"]}, {"b": Reference(("k",), parent, ("p",)), "c": Reference(("m",), parent, ("p",))})
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Exchange RoundRobinPartitioning") == 1 and "ReadSchema: struct<k:bigint,m:int>" in plan
    # whole numbers are counted as such, text is made of the keys reported
    assert "json" not in plan[plan.index("Exchange hashpartitioning"):].lower()
    got = sorted(map(tuple, report.collect()))
    pairs = {}
    for i in range(1000):
        pairs[i % 100, i % 7] = pairs.get((i % 100, i % 7), 0) + 1
    assert got == sorted([("a", "duplicate_key", f'["{k}","{m}"]', n) for (k, m), n in pairs.items() if n > 1]
                         + [("b", "orphan", f'["{k}"]', 10) for k in range(50, 100)])


def test_numbers_and_texts_in_one_key(spark):
    child = spark.createDataFrame([(1, "x", 1.5, 300), (1, "x", -0.0, 300), (2, None, 0.0, 7), (None, None, 0.0, None)],
                                  "A long, b string, c double, d int")
    parent = spark.createDataFrame([("x", 44, 1), ("y", None, 2), (None, 7, None)], "s string, t byte, u long")
    report = key_report(child, {"text first": ["b", "a"], "double": ["c"]}, {  # names as Spark finds them: A is a
        "pair": Reference(("b", "a"), parent, ("s", "u")), "narrower": Reference(("d",), parent, ("t",))})
    assert sorted(map(tuple, report.collect())) == [
        ("double", "duplicate_key", '["0.0"]', 2), ("narrower", "orphan", '["300"]', 2),
        ("text first", "duplicate_key", '["x","1"]', 2), ("text first", "null_key", "[null,\"2\"]", 1),
        ("text first", "null_key", "[null,null]", 1)]
