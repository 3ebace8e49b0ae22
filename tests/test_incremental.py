"""Loads that write changed key buckets only, and the feed of what generations change."""

import hashlib
import os
import random
import uuid

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from relsync.operators.buckets import bucket_digests, compare_buckets, key_bucket
from relsync.operators.merge import change_rows
from relsync.plans.incremental import MAX_BUCKETS, IncrementalSink
from relsync.plans.release_load import load_release
from relsync.plans.sink import CatalogSink
from relsync.spec import DatasetSpec, Source
from relsync.streaming import change_feed
from relsync.streaming.change_feed import ChangeFeed, apply_changes, register
from tests.release_tree import table, write_release


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def sink(spark):
    return IncrementalSink(spark, database="db_" + uuid.uuid4().hex[:8], buckets=16, rows_per_file=200)


def plain_bucket(key, buckets):
    return int(hashlib.md5(f'["{key}"]'.encode()).hexdigest()[:15], 16) % buckets


def items(spark, n, salt="", extra=()):
    return spark.range(n).select("id", F.concat(F.lit("v" + salt), "id").alias("v"), F.array("id", F.lit(None)).alias("l"), *extra)


# --- digests -----------------------------------------------------------------------------------
def test_digests_do_not_depend_on_order_and_tell_every_change(spark):
    base = items(spark, 300)
    one = bucket_digests(base, ["id"], 8)
    assert {r["bucket"]: r["rows"] for r in one.collect()} == {
        b: sum(plain_bucket(i, 8) == b for i in range(300)) for b in range(8)}
    other = bucket_digests(base.repartition(7, "v"), ["id"], 8)
    assert compare_buckets(one, other).where("changed").count() == 0
    edits = {
        "a value": base.withColumn("v", F.when(F.col("id") == 7, "x").otherwise(F.col("v"))),
        "a null": base.withColumn("v", F.when(F.col("id") == 7, None).otherwise(F.col("v"))),
        "inside": base.withColumn("l", F.when(F.col("id") == 7, F.array(F.lit(None).cast("long"), "id")).otherwise(F.col("l"))),
        "deleted": base.where("id <> 7"),
        "inserted": base.unionByName(spark.sql("SELECT 1000L AS id, 'v' AS v, array(1L) AS l")),
    }
    for what, df in edits.items():
        key = 1000 if what == "inserted" else 7
        changed = compare_buckets(bucket_digests(df, ["id"], 8), one).where("changed").collect()
        assert [r["bucket"] for r in changed] == [plain_bucket(key, 8)], what
    swapped = base.select("id", F.when(F.col("id") < 2, F.concat(F.lit("v"), 1 - F.col("id"))).otherwise(F.col("v")).alias("v"), "l")
    assert compare_buckets(bucket_digests(swapped, ["id"], 1), bucket_digests(base, ["id"], 1)).where("changed").count() == 1
    gone = compare_buckets(bucket_digests(base.limit(0), ["id"], 8), one)
    assert gone.where("changed AND rows_new = 0").count() == 8


def test_buckets_of_composite_and_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, None)], "k long, t string")
    got = [r[0] for r in df.select(key_bucket(["k", "t"], 1 << 20)).collect()]
    assert got == [int(hashlib.md5(t).hexdigest()[:15], 16) % (1 << 20) for t in (b'["1","a"]', b'["1",null]', b"[null,null]")]


# --- the sink --------------------------------------------------------------------------------------
def written(spark, sink, gen):
    return {r["__bucket"] for r in spark.table(sink.fq(gen)).select("__bucket").distinct().collect()}


def test_a_few_changed_keys_write_their_buckets_only(spark, sink):
    assert sink.merge("t", items(spark, 1000), ["id"]) == 1000
    first = sink.current_generation("t")
    assert written(spark, sink, first) == set(range(16))
    changed = [i for i in range(1000) if plain_bucket(i, 16) in (3, 4)][:10]  # 1 % of the keys
    second = items(spark, 1000).withColumn("v", F.when(F.col("id").isin(changed), "new").otherwise(F.col("v")))
    assert sink.merge("t", second, ["id"]) == 1000
    gen = sink.current_generation("t")
    assert written(spark, sink, gen) == {plain_bucket(i, 16) for i in changed}
    assert sink.holders(gen) == {first: sorted(set(range(16)) - written(spark, sink, gen)), gen: sorted(written(spark, sink, gen))}
    assert rows(sink.read("t")) == rows(second) and sink.read("t").columns == ["id", "v", "l"]
    assert {r["bucket"] for r in sink.changed_buckets(first, gen).where("changed").collect()} == written(spark, sink, gen)
    # nothing changed: nothing is written, the table stays
    assert sink.merge("t", second, ["id"]) == 1000
    assert written(spark, sink, sink.current_generation("t")) == set() and rows(sink.read("t")) == rows(second)


@pytest.mark.parametrize("keep", [1, 3])
def test_generations_go_when_no_kept_one_reads_them(spark, keep):
    sink = IncrementalSink(spark, database="db_" + uuid.uuid4().hex[:8], buckets=4, keep_generations=keep)
    r, state, history = random.Random(keep), {i: "v0" for i in range(40)}, []
    for step in range(5):
        for _ in range(3):
            state[r.randrange(60)] = f"v{step}"
            state.pop(r.choice(sorted(state)))
        sink.merge("t", spark.createDataFrame(sorted(state.items()), "id long, v string"), ["id"])
        history.insert(0, sorted(state.items()))
        published = sink.published("t")
        assert len(published) == min(keep, step + 1)
        for gen, was in zip(published, history):  # every kept generation can still be read whole
            assert rows(spark.sql(sink._body(gen))) == sorted(was, key=repr)
        read = {g for k in published for g in sink.holders(k)}
        assert set(sink.generations("t")) == read | set(published)
        assert len(sink._tables_like("t__b")) == len(published)


def test_schema_changes_and_other_bucket_numbers_write_all(spark, sink):
    sink.merge("t", items(spark, 100), ["id"])
    sink.merge("t", items(spark, 100, extra=[F.lit(1).alias("n")]), ["id"])
    assert written(spark, sink, sink.current_generation("t")) == {plain_bucket(i, 16) for i in range(100)}
    assert rows(sink.read("t")) == rows(items(spark, 100, extra=[F.lit(1).alias("n")]))
    sink.merge("t", items(spark, 100), ["id"])  # n is carried over: nothing changes
    assert written(spark, sink, sink.current_generation("t")) == set()
    fewer = IncrementalSink(spark, database=sink.database, buckets=8)
    fewer.merge("t", items(spark, 100), ["id"])
    assert written(spark, fewer, fewer.current_generation("t")) == set(range(8))
    fewer.replace("t", items(spark, 100).withColumn("id", F.col("id").cast("int")), ["id"])  # another type, equal text
    assert written(spark, fewer, fewer.current_generation("t")) == set(range(8))
    for bad in (0, MAX_BUCKETS + 1):
        with pytest.raises(ValueError):
            IncrementalSink(spark, buckets=bad)


def test_empty_tables_plain_tables_and_tables_of_the_other_sink(spark, sink):
    assert sink.merge("e", items(spark, 0), ["id"]) == 0 and rows(sink.read("e")) == []
    assert sink.merge("e", items(spark, 30), ["id"]) == 30 and sink.merge("e", items(spark, 0), ["id"]) == 0
    assert sink.read("e").columns == ["id", "v", "l"] and rows(sink.read("e")) == []
    items(spark, 20).write.saveAsTable(sink.fq("p"))
    assert sink.merge("p", items(spark, 30), ["id"]) == 30 and rows(sink.read("p")) == rows(items(spark, 30))
    whole = CatalogSink(spark, database=sink.database)
    whole.merge("w", items(spark, 20), ["id"])
    sink.merge("w", items(spark, 25), ["id"])
    assert rows(sink.read("w")) == rows(items(spark, 25)) and len(sink.published("w")) == 2
    assert sink.replace("k", items(spark, 5), []) == 5  # without a key it is written whole


def test_a_release_loads_incrementally_with_counts(spark, tmp_path, sink):
    src, spec = Source(str(tmp_path / "rel")), [DatasetSpec("t", ("id",))]
    write_release(src.root, "22.04", {"t": [table(id=pa.array(range(200)), v=pa.array(["a"] * 200))]})
    write_release(src.root, "22.06", {"t": [table(id=pa.array(range(1, 201)), v=pa.array(["b"] + ["a"] * 199))]})
    load_release(spark, spec, src, sink, version="22.04")
    r = load_release(spark, spec, src, sink, statistics=True).first()
    assert (r["rows_loaded"], r["inserted"], r["updated"], r["deleted"], r["unchanged"]) == (200, 1, 1, 1, 198)
    assert written(spark, sink, sink.current_generation("t")) <= {plain_bucket(i, 16) for i in (0, 1, 200)}
    write_release(src.root, "22.09", {"t": [table(id=pa.array([1, 1]), v=pa.array(["a", "b"]))]})
    before = (rows(sink.read("t")), sink.generations("t"), sink._tables_like("t__b"))
    assert load_release(spark, spec, src, sink).first()["status"] == "failed"
    assert (rows(sink.read("t")), sink.generations("t"), sink._tables_like("t__b")) == before


def test_a_staged_generation_that_is_discarded_leaves_nothing(spark, sink):
    sink.merge("t", items(spark, 50), ["id"])
    before = (sink.generations("t"), sink._tables_like("t__b"))
    staged = sink.stage("t", items(spark, 60), ["id"], "delta")
    assert rows(staged.data) == rows(items(spark, 60)) and rows(sink.read("t")) == rows(items(spark, 50))
    staged.discard()
    assert (sink.generations("t"), sink._tables_like("t__b")) == before


def test_many_rows_of_a_bucket_are_spread_over_files(spark):
    sink = IncrementalSink(spark, database="db_" + uuid.uuid4().hex[:8], buckets=2, rows_per_file=100)
    sink.merge("t", items(spark, 1000), ["id"])
    files = spark.table(sink.fq(sink.current_generation("t"))).inputFiles()
    assert len(files) > 2


# --- changes ---------------------------------------------------------------------------------------
def test_change_rows_turn_old_into_new(spark):
    old = spark.createDataFrame([(i, i % 3, {"k": i}) for i in range(40)], "id long, v int, m map<string,int>")
    new = spark.createDataFrame([(i, (i + (i % 7 == 0)) % 3, {"k": i}, None) for i in range(10, 50)], "id long, v int, m map<string,int>, n string")
    got = change_rows(new, old, ["id"])
    ops = {r["op"]: r["count"] for r in got.groupBy("op").count().collect()}
    assert ops == {"insert": 10, "delete": 10, "update": len([i for i in range(10, 40) if i % 7 == 0])}
    assert rows(apply_changes(old, got, ["id"]).select("id", "v", "n")) == rows(new.select("id", "v", "n"))
    assert {r["v"] for r in got.where("op = 'delete' AND id = 4").collect()} == {1}
    assert change_rows(new, None, ["id"]).where("op = 'insert'").count() == 40
    assert change_rows(new, new, ["id"]).count() == 0
    text = old.withColumn("v", F.lit("text"))
    assert change_rows(old, text, ["id"]).where("op = 'update'").count() == 40


@pytest.mark.parametrize("kind", [CatalogSink, IncrementalSink])
def test_the_feed_replays_every_generation_under_restart(spark, tmp_path, kind):
    register(spark)
    feed = ChangeFeed(str(tmp_path / "feed"))
    sink = kind(spark, database="db_" + uuid.uuid4().hex[:8], feed=feed, keep_generations=1)
    out, ckpt, seen = str(tmp_path / "out"), str(tmp_path / "ckpt"), []

    def read_on():
        def batch(df, epoch):
            seen.append(sorted({r["seq"] for r in df.select("seq").distinct().collect()}))
            df.write.mode("overwrite").parquet(f"{out}/{epoch:05d}")

        stream = spark.readStream.format("relsync_changes").schema("seq long, generation string, op string, id long, v string").load(feed.path("t"))
        stream.writeStream.foreachBatch(batch).option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination(120)

    r, state, held = random.Random(1), {i: "v0" for i in range(50)}, None
    for step in range(5):
        for _ in range(4):
            state[r.randrange(70)] = f"v{step}"
            state.pop(r.choice(sorted(state)))
        sink.merge("t", spark.createDataFrame(sorted(state.items()), "id long, v string"), ["id"])
        if step != 2:  # one run of the reader misses a generation and takes two at once later
            read_on()
            for seq in seen[-1]:
                changes = spark.read.parquet(f"{out}/*").where(F.col("seq") == seq).drop("seq", "generation")
                held = changes.drop("op").limit(0) if held is None else held
                held = spark.createDataFrame(apply_changes(held, changes, ["id"]).collect(), held.schema)
            assert rows(held) == rows(sink.read("t")) == sorted(state.items(), key=repr)
    assert seen == [[1], [2], [3, 4], [5]]
    assert [n for n, _ in feed.listed("t")] == [1, 2, 3, 4, 5]
    batch = spark.read.format("relsync_changes").option("after", 1).option("upto", 3).load(feed.path("t"))
    assert batch.columns == ["seq", "generation", "op", "id", "v"] and {r["seq"] for r in batch.collect()} == {2, 3}


def test_a_generation_is_listed_once_published_and_never_before(spark, tmp_path):
    class Broken(CatalogSink):
        broken = False

        def _point(self, table, kept):
            if self.broken:
                raise RuntimeError("catalog gone")
            super()._point(table, kept)

    feed = ChangeFeed(str(tmp_path / "feed"))
    sink = Broken(spark, database="db_" + uuid.uuid4().hex[:8], feed=feed)
    staged = sink.stage("t", items(spark, 5), ["id"], "delta")
    assert feed.listed("t") == [] and change_feed.files_of(feed.path("t"), staged.generation)
    staged.publish()
    assert feed.listed("t") == [(1, staged.generation)] and feed.publish("t", staged.generation) == 1
    sink.broken = True
    failed = sink.stage("t", items(spark, 6), ["id"], "delta")
    with pytest.raises(RuntimeError):
        failed.publish()
    failed.discard()
    assert len(feed.listed("t")) == 1 and not os.path.exists(f"{feed.path('t')}/rows/{failed.generation}")
    # a process that ended after its switch: the next publish lists what it left unlisted
    sink.broken = False
    second = sink.stage("t", items(spark, 7), ["id"], "delta")
    sink._point("t", [second.generation, staged.generation])
    third = sink.stage("t", items(spark, 8), ["id"], "delta")
    third.publish()
    assert [g for _, g in feed.listed("t")] == [staged.generation, second.generation, third.generation]


def test_a_feed_that_starts_later_and_tables_without_a_key(spark, tmp_path):
    database = "db_" + uuid.uuid4().hex[:8]
    CatalogSink(spark, database=database).merge("t", items(spark, 5), ["id"])
    feed = ChangeFeed(str(tmp_path / "feed"))
    sink = CatalogSink(spark, database=database, feed=feed)
    sink.merge("t", items(spark, 6), ["id"])
    assert [n for n, _ in feed.listed("t")] == [1]
    register(spark)
    assert [r["id"] for r in spark.read.format("relsync_changes").load(feed.path("t")).collect()] == [5]
    with pytest.raises(ValueError, match="no key"):
        sink.replace("k", items(spark, 3), [])
    with pytest.raises(Exception, match="no published generation"):
        spark.read.format("relsync_changes").load(feed.path("nothing")).collect()


def test_columns_that_come_later_are_null_before(spark, tmp_path):
    feed = ChangeFeed(str(tmp_path / "feed"))
    sink = IncrementalSink(spark, database="db_" + uuid.uuid4().hex[:8], feed=feed, buckets=4)
    sink.merge("t", items(spark, 4), ["id"])
    sink.merge("t", items(spark, 4, extra=[F.lit(2.5).alias("x"), F.lit(None).cast("date").alias("d")]), ["id"])
    register(spark)
    got = spark.read.format("relsync_changes").load(feed.path("t"))
    assert got.columns == ["seq", "generation", "op", "id", "v", "l", "d", "x"]
    assert {(r["seq"], r["op"], r["x"]) for r in got.collect()} == {(1, "insert", None), (2, "update", 2.5)}
    assert {tuple(r["l"]) for r in got.collect()} == {(i, None) for i in range(4)}
