import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from relsync.operators.checks import (KeyViolation, check_foreign_key, check_primary_key,
                                      key_violations, orphan_keys, orphan_rows)
from relsync.operators.evolve import align, diff_schemas, schema_diff, union_by_name
from relsync.operators.merge import (diff_snapshots, merge_counts, merge_snapshot, stale_rows)


def plan_text(df, mode="formatted"):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((v is None, v if v is not None else 0) for v in t))


# ---- key checks ----------------------------------------------------------------------------
def seats(n=60):
    """(hall, seat, price): every (hall, seat) once."""
    return [(f"h{i % 4}", i // 4, i * 1.5) for i in range(n)]


SEATS = "hall string, seat long, price double"


def test_key_violations_are_those_that_counting_finds(spark):
    rows_ = seats() + [("h1", 2, 0.0)] * 3 + [(None, 2, 1.0), (None, 2, 2.0), ("h3", None, 3.0)]
    df = spark.createDataFrame(rows_, SEATS)
    counted = Counter((h, s) for h, s, _ in rows_)
    want = {(h, s, "null_key" if h is None or s is None else "duplicate_key", n)
            for (h, s), n in counted.items() if n > 1 or h is None or s is None}
    assert {tuple(r) for r in key_violations(df, ["hall", "seat"]).collect()} == want
    with pytest.raises(KeyViolation, match="null_key|duplicate_key"):
        check_primary_key(df, ["hall", "seat"])
    check_primary_key(spark.createDataFrame(seats(), SEATS), ["hall", "seat"])


def test_orphans_of_a_composite_foreign_key(spark):
    parent = spark.createDataFrame([r for r in seats() if r[1] % 3], SEATS)
    booked = [(i, f"h{i % 5}" if i % 11 else None, i % 17 if i % 13 else None) for i in range(200)]
    child = spark.createDataFrame(booked, "ticket long, h string, s long")
    known = {(h, s) for h, s, _ in seats() if s % 3}
    gone = [(t, h, s) for t, h, s in booked if h is not None and s is not None and (h, s) not in known]
    assert {tuple(r) for r in orphan_rows(child, parent, ["h", "s"], ["hall", "seat"]).collect()} == set(gone)
    counts = Counter((h, s) for _, h, s in gone)
    assert {tuple(r) for r in orphan_keys(child, parent, ["h", "s"], ["hall", "seat"]).collect()} == {(*k, n) for k, n in counts.items()}
    with pytest.raises(KeyViolation, match="orphans"):
        check_foreign_key(child, parent, ["h", "s"], ["hall", "seat"])
    check_foreign_key(child, spark.createDataFrame([(f"h{h}", s, 0.0) for h in range(5) for s in range(17)], SEATS), ["h", "s"], ["hall", "seat"])


def test_hot_key_is_preaggregated(spark):
    df = spark.range(0, 20000).select(F.lit(7).alias("k")).union(spark.range(5).select("id"))
    v = key_violations(df, ["k"])
    plan = plan_text(v)
    assert "partial_count" in plan
    assert rows(v, "k", "n") == [(7, 20000)]


# ---- evolution -----------------------------------------------------------------------------
def test_drift_and_alignment_of_generated_schemas(spark):
    kinds = ["bigint", "string", "double", "date"]
    final = ", ".join(f"c{i} {kinds[i % 4]}" for i in range(12))
    new = ", ".join(f"C{i} {kinds[(i + (i % 5 == 0)) % 4]}" for i in range(17, 3, -1))
    a, b = spark.createDataFrame([], new), spark.createDataFrame([], final)
    d = diff_schemas(a.schema, b.schema)
    assert d.removed == ("c0", "c1", "c2", "c3") and d.type_changed == ("c5", "c10")
    assert set(d.same) == {f"c{i}" for i in range(4, 12)} - {"c5", "c10"}
    assert d.added == tuple(sorted(f"C{i}" for i in range(12, 18)))
    report = {r["column"]: (r["status"], r["staging_type"], r["final_type"]) for r in schema_diff(spark, a, b).collect()}
    assert report["c5"] == ("type_changed", "double", "string") and report["c0"] == ("removed", None, "bigint")
    assert report["C13"] == ("added", "string", None)
    assert align(b, a.schema).columns == [f"c{i}" for i in range(12)] + list(d.added)


def test_union_of_parts_with_different_columns(spark):
    parts = [spark.createDataFrame([(i, f"v{i}")], f"k long, only{i} string") for i in range(4)]
    got = {r["k"]: [r[f"only{i}"] for i in range(4)] for r in union_by_name(parts).collect()}
    assert got == {i: [f"v{i}" if j == i else None for j in range(4)] for i in range(4)}


# ---- merge -----------------------------------------------------------------------------------
def test_merge_equals_a_dictionary_of_rows(spark):
    old = {(h, s): p for h, s, p in seats()}
    new = {k: (p if k[1] % 2 else p + 1) for k, p in old.items() if k[1] % 5} | {("h9", i): 0.25 for i in range(7)}
    f = spark.createDataFrame([(*k, p) for k, p in old.items()], SEATS)
    s = spark.createDataFrame([(*k, p) for k, p in new.items()], SEATS)
    keys = ["hall", "seat"]
    assert {(r.hall, r.seat): r.price for r in merge_snapshot(s, f, keys).collect()} == new
    assert {(r.hall, r.seat) for r in stale_rows(f, s, keys).collect()} == set(old) - set(new)
    want = Counter("insert" if k not in old else "delete" if k not in new else "unchanged" if old[k] == new[k] else "update" for k in {*old, *new})
    counts = merge_counts(s, f, keys)
    assert {op: counts[op] for op in want} == want
    assert (counts["deleted"], counts["upserted"]) == (want["delete"], len(new))
    assert Counter(r.op for r in diff_snapshots(s, f, keys).collect()) == want
    assert merge_snapshot(s, None, keys).count() == len(new)


def test_merge_evolution_carry_and_types(spark):
    f = spark.createDataFrame([(1, 10, "keep1"), (2, 20, "keep2")],
                              "id int, v int, legacy string")
    s = spark.createDataFrame([(2, 200, "n2"), (3, 300, "n3")], "id bigint, v bigint, extra string")
    m = merge_snapshot(s, f, ["id"])
    assert m.dtypes == [("id", "int"), ("v", "int"), ("legacy", "string"), ("extra", "string")]
    assert rows(m) == [(2, 200, "keep2", "n2"), (3, 300, None, "n3")]


def test_merge_type_drift_overflow_fails(spark):
    f = spark.createDataFrame([(1, 1)], "id bigint, v int")
    s = spark.createDataFrame([(1, 2**40)], "id bigint, v bigint")
    with pytest.raises(Exception):
        merge_snapshot(s, f, ["id"]).collect()


def test_merge_all_columns_key_inserts(spark):
    f = spark.createDataFrame([(1, 1), (2, 2)], "a bigint, b bigint")
    s = spark.createDataFrame([(2, 2), (3, 3)], "a bigint, b bigint")
    assert rows(merge_snapshot(s, f, ["a", "b"])) == [(2, 2), (3, 3)]


def test_merge_without_removed_column_has_no_join(spark):
    f = spark.createDataFrame([(1, "a")], "id bigint, data string")
    s = spark.createDataFrame([(2, "b", 5)], "id bigint, data string, more int")
    plan = plan_text(merge_snapshot(s, f, ["id"]), "extended")
    assert "Join" not in plan


def test_merge_missing_key_rejected(spark):
    f = spark.createDataFrame([(1, "a")], "id bigint, data string")
    s = spark.createDataFrame([(1, "a")], "ident bigint, data string")
    with pytest.raises(ValueError, match="missing"):
        merge_snapshot(s, f, ["id"])


def test_orphan_check_aggregates_before_the_join(spark):
    # one parent key referenced by a third of all child rows
    child = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") + 10).alias("fk"))
    parent = spark.range(0, 20000).select(F.col("id").alias("pk"))
    out = orphan_keys(child, parent, ["fk"], ["pk"])
    plan = plan_text(out, "extended")
    optimized = plan[plan.index("== Optimized Logical Plan =="):plan.index("== Physical Plan ==")]
    assert optimized.index("Join LeftAnti") < optimized.index("Aggregate")  # aggregate below the join
    expected = {i + 10 for i in range(30000) if i % 3 and i + 10 >= 20000}
    assert {r["fk"] for r in out.collect()} == expected


def test_diff_digest_equals_exact(spark):
    f = spark.createDataFrame([(1, "a", 1.5), (2, "b", None), (3, "c", 2.0)], "id bigint, s string, x double")
    s = spark.createDataFrame([(1, "a", 1.5), (2, "b", 0.0), (4, "d", 1.0)], "id bigint, s string, x double")
    exact = rows(diff_snapshots(s, f, ["id"]))
    assert exact == [(1, "unchanged"), (2, "update"), (3, "delete"), (4, "insert")]
    assert rows(diff_snapshots(s, f, ["id"], compare="digest")) == exact


def test_replace_snapshot_checks_key(spark):
    from relsync.operators.merge import replace_snapshot
    ok = spark.createDataFrame([(1, "a")], "id bigint, data string")
    assert replace_snapshot(ok, ["id"]) is ok
    with pytest.raises(KeyViolation):
        replace_snapshot(ok.union(ok), ["id"])


def test_type_drift_follows_store_assignment(spark):
    f = spark.createDataFrame([(1, 1.5, "a", 7)], "id bigint, score double, label string, n int")
    s = spark.createDataFrame([(1, "2.5", 3, 8)], "id bigint, score string, label int, n bigint")
    with pytest.raises(TypeError, match="score"):
        merge_snapshot(s, f, ["id"])          # text into a double column: refused
    ok = spark.createDataFrame([(1, 2.5, 3, 8)], "id bigint, score float, label int, n bigint")
    m = merge_snapshot(ok, f, ["id"])         # float -> double, int -> string, bigint -> int
    assert m.dtypes == [("id", "bigint"), ("score", "double"), ("label", "string"), ("n", "int")]
    assert rows(m) == [(1, 2.5, "3", 8)]


def test_schema_diff_with_non_null_counts(spark):
    final = spark.createDataFrame([(1, 1.0, None), (2, None, None)], "id bigint, score double, gone string")
    new = spark.createDataFrame([(1, "x", None)], "ID bigint, score string, extra int")
    got = {r["column"]: (r["status"], r["staging_non_null"], r["final_non_null"])
           for r in schema_diff(spark, new, final, counts=True).collect()}
    assert got == {"id": ("same", 1, 2), "score": ("type_changed", 1, 1),
                   "gone": ("removed", None, 0), "extra": ("added", 0, None)}


def test_repeated_keys_are_refused_everywhere(spark):
    once = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, s string")
    twice = spark.createDataFrame([(1, "a")] * 50 + [(2, "b")], "id bigint, s string")
    carried = twice.withColumn("old", F.lit(1))
    for call in (
        lambda: diff_snapshots(once, twice, ["id"]), lambda: diff_snapshots(twice, once, ["id"]),
        lambda: merge_counts(once, twice, ["id"]), lambda: merge_snapshot(twice, once, ["id"]),
        lambda: merge_snapshot(once, carried, ["id"]), lambda: merge_snapshot(twice, None, ["id"]),
    ):
        with pytest.raises(KeyViolation):
            call()
    # a key change: the table's rows are unique by (id, part), not by id alone
    wide = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "id bigint, part bigint, old string")
    with pytest.raises(KeyViolation):
        merge_snapshot(spark.createDataFrame([(1, "n")], "id bigint, s string"), wide, ["id"])


def test_values_that_a_column_cannot_hold_fail(spark):
    f = spark.createDataFrame([(1, 1, None, None)], "id bigint, n bigint, d date, t string")
    good = spark.createDataFrame([(1, 3.0, "2020-01-02 00:00:00")], "id bigint, n double, x string").select(
        "id", "n", F.col("x").cast("timestamp_ntz").alias("d"))
    assert rows(merge_snapshot(good, f.drop("t"), ["id"])) == [(1, 3, dt.date(2020, 1, 2))]
    for bad in ("2.7D AS n", "double('NaN') AS n", "2.50BD AS n", "timestamp_ntz'2020-01-02 00:00:01' AS d"):
        with pytest.raises(Exception, match="cannot hold|CAST|OVERFLOW"):
            merge_snapshot(spark.range(1, 2).selectExpr("id", bad), f, ["id"], check_keys=False).collect()
    for kind in ("named_struct('a', 1) AS t", "array(1) AS t", "map('a', 1) AS t"):
        with pytest.raises(TypeError, match="cannot be stored"):
            merge_snapshot(spark.range(1, 2).selectExpr("id", kind), f, ["id"])


def test_diff_sees_microseconds_maps_and_variants(spark):
    def side(micros, value):
        return spark.range(3).selectExpr(
            "id", f"timestamp_micros(id * 1000000 + {micros}) AS at", f"named_struct('at', timestamp_micros({micros})) AS s",
            f"map('b', {value}, 'a', id) AS m", f"""parse_json('{{"k": {value}}}') AS v""", f"array(map('x', {value})) AS l")

    for compare in ("exact", "digest"):
        ops = lambda a, b: {r.op for r in diff_snapshots(a, b, ["id"], compare=compare).collect()}  # noqa: E731, B023
        assert ops(side(123456, 1), side(123456, 1)) == {"unchanged"}
        assert ops(side(123456, 1).drop("m", "v", "l"), side(123999, 1).drop("m", "v", "l")) == {"update"}
        assert ops(side(0, 1).drop("at", "s"), side(0, 2).drop("at", "s")) == {"update"}
    swapped = side(0, 1).withColumn("m", F.expr("map('a', id, 'b', 1)"))
    assert {r.op for r in diff_snapshots(side(0, 1), swapped, ["id"]).collect()} == {"unchanged"}
