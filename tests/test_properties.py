"""Random snapshots: the merge equals delete-then-upsert done row by row in Python."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from relsync.operators.checks import key_violations
from relsync.operators.merge import diff_snapshots, merge_snapshot

keys = st.sets(st.integers(0, 15), max_size=10)
vals = st.one_of(st.none(), st.integers(-3, 3))
texts = st.one_of(st.none(), st.sampled_from(["a", "b", "é", "tab\there"]))

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@SETTINGS
@given(st.data())
def test_merge_equals_delete_then_upsert(spark, data):
    fkeys, skeys = data.draw(keys), data.draw(keys)
    final = {k: (data.draw(vals), data.draw(texts)) for k in fkeys}          # id, v, legacy
    staging = {k: (data.draw(vals), data.draw(texts)) for k in skeys}        # id, v, extra
    fdf = spark.createDataFrame([(k, *v) for k, v in final.items()], "id int, v int, legacy string")
    sdf = spark.createDataFrame([(k, *v) for k, v in staging.items()], "id bigint, v bigint, extra string")

    # the reference's two statements, row by row
    table = {k: {"v": v, "legacy": leg} for k, (v, leg) in final.items() if k in staging}
    for k, (v, extra) in staging.items():
        row = table.setdefault(k, {"v": None, "legacy": None})
        row.update(v=v, extra=extra)
    expected = sorted(((k, r["v"], r["legacy"], r.get("extra")) for k, r in table.items()), key=repr)

    merged = merge_snapshot(sdf, fdf, ["id"])
    assert merged.columns == ["id", "v", "legacy", "extra"]
    assert _rows(merged) == expected

    ops = dict((r["id"], r["op"]) for r in diff_snapshots(sdf, fdf, ["id"]).collect())
    for k in fkeys | skeys:
        if k not in final:
            assert ops[k] == "insert"
        elif k not in staging:
            assert ops[k] == "delete"
        else:
            assert ops[k] == ("unchanged" if staging[k][0] == final[k][0] else "update")


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 2)), max_size=15))
def test_key_violations_match_counting(spark, pairs):
    df = spark.createDataFrame(pairs, "a int, b int")
    counts = {}
    for p in pairs:
        counts[p] = counts.get(p, 0) + 1
    expected = sorted(((a, b, "null_key" if a is None else "duplicate_key", n)
                       for (a, b), n in counts.items() if a is None or n > 1), key=repr)
    assert _rows(key_violations(df, ["a", "b"])) == expected


small_text = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=8)
structs = st.one_of(st.none(), st.fixed_dictionaries({
    "a": st.one_of(st.none(), small_text),
    "b": st.one_of(st.none(), st.integers(-2**40, 2**40)),
    "c": st.one_of(st.none(), st.lists(st.one_of(st.none(), small_text), max_size=4)),
}))


@SETTINGS
@given(st.lists(structs, min_size=1, max_size=6))
def test_struct_json_round_trips(spark, values):
    import json

    from relsync.operators.projection import project
    from relsync.spec import DatasetSpec
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)],
                               "id bigint, s struct<a:string, b:bigint, c:array<string>>")
    got = {r["id"]: r["s"] for r in project(df, DatasetSpec("x", ("id",))).collect()}
    for i, v in enumerate(values):
        assert (got[i] is None) if v is None else (json.loads(got[i]) == v)


@SETTINGS
@given(st.dictionaries(st.sampled_from("abcdefgh"), st.sampled_from(["h1", "h2"]), max_size=6),
       st.dictionaries(st.sampled_from("abcdefgh"), st.sampled_from(["h1", "h2"]), max_size=6))
def test_compare_hashes_matches_model(spark, files, manifest):
    from relsync.operators.integrity import compare_hashes
    fdf = spark.createDataFrame(list(files.items()), "path string, sha1 string")
    mdf = spark.createDataFrame(list(manifest.items()), "path string, sha1 string")
    got = {r["path"]: r["status"] for r in compare_hashes(fdf, mdf).collect()}
    want = {}
    for p in set(files) | set(manifest):
        if p not in manifest:
            want[p] = "not_in_manifest"
        elif p not in files:
            want[p] = "missing_file"
        else:
            want[p] = "ok" if files[p] == manifest[p] else "mismatch"
    assert got == want


@SETTINGS
@given(st.lists(st.one_of(
    st.tuples(st.integers(0, 99), st.integers(0, 99)).map(lambda t: f"{t[0]:02d}.{t[1]:02d}"),
    st.sampled_from(["9.1", "2022.06", "22.06-rc", "README.md", "1.2.3", "ab.cd"])), max_size=12))
def test_version_filter_and_order_match_model(spark, names):
    import re

    from pyspark.sql import functions as F

    from relsync.functions.versions import is_version, newest_first
    df = spark.createDataFrame([(n,) for n in names], "v string")
    got = [r["v"] for r in df.where(is_version(F.col("v"))).distinct()
           .orderBy(*newest_first(F.col("v"))).collect()]
    want = sorted({n for n in names if re.fullmatch(r"\d{2}\.\d{2}", n)},
                  key=lambda s: [int(p) for p in s.split(".")], reverse=True)
    assert got == want
