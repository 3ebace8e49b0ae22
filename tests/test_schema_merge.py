"""Schemas of files united by one aggregation over their footers."""

import datetime as dt
import os
import random
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from relsync.sources.inventory import file_inventory
from relsync.sources.parquet import (SchemaMismatch, footer_places, merge_places, merged_schema, read_dataset, widen_fields)


def put(folder, name, **cols):
    os.makedirs(folder, exist_ok=True)
    pq.write_table(pa.table(cols), os.path.join(folder, name))


def test_the_merged_schema_equals_folding_sparks_own(spark, tmp_path):
    d = str(tmp_path / "d")
    put(d, "a.parquet", i=pa.array([1], pa.int8()), s=pa.array([{"X": 1, "y": [{"z": "t"}]}]), d=pa.array([Decimal("1.5")], pa.decimal128(9, 2)))
    put(d, "b.parquet", I=pa.array([1], pa.uint32()), t=pa.array([dt.datetime(2024, 1, 1)], pa.timestamp("us")),
        s=pa.array([{"w": 1.5, "x": 2.5}]), u=pa.array([3], pa.uint64()), q=pa.array([b"x"]))
    put(d, "c.parquet", z=pa.array([dt.datetime(2024, 1, 1)], pa.timestamp("us", "UTC")), m=pa.array([[("k", 1)]], pa.map_(pa.string(), pa.int32())),
        f=pa.array([1.0], pa.float32()), day=pa.array([dt.date(2024, 1, 1)]), b=pa.array([True]), l=pa.array([[1]], pa.large_list(pa.int16())))
    spark.range(1).selectExpr("id AS i", "map('k', id) AS m", "named_struct('y', array(named_struct('z', 'a', 'n', 1))) AS s").write.parquet(d + "/spark")
    for f in os.listdir(d + "/spark"):
        if f.endswith(".parquet"):
            os.rename(f"{d}/spark/{f}", f"{d}/d.parquet")
    inventory = file_inventory(spark, f"{d}/*.parquet")
    own = [spark.read.parquet(f"{d}/{n}.parquet").schema for n in "abcd"]
    assert merged_schema(spark, inventory).simpleString() == widen_fields(own).simpleString()
    got = read_dataset(spark, f"{d}/*.parquet", mode="merge")
    assert got.count() == 4 and {r["i"] for r in got.collect()} == {1, None, 0}


def test_the_order_of_footer_rows_does_not_matter(spark, tmp_path):
    d, r = str(tmp_path / "d"), random.Random(2)
    for i in range(12):
        cols = {f"c{r.randrange(8)}": pa.array([1], r.choice([pa.int32(), pa.int64(), pa.float64()])) for _ in range(4)}
        put(d, f"{i:02d}.parquet", **cols)
    places = footer_places(file_inventory(spark, f"{d}/*.parquet")).cache()
    once = sorted(map(tuple, merge_places(places).collect()))
    for seed in range(3):
        assert sorted(map(tuple, merge_places(places.orderBy(F.rand(seed))).collect())) == once


def test_a_thousand_different_footers_take_one_job(spark, tmp_path):
    d = str(tmp_path / "d")
    for i in range(1000):
        put(d, f"{i:04d}.parquet", id=pa.array([i]), **{f"c{i}": pa.array([i], pa.int32())})
    inventory = file_inventory(spark, f"{d}/*.parquet")
    inventory.count()
    sc = spark.sparkContext
    sc.setJobGroup("schemas", "schemas")
    try:
        schema = merged_schema(spark, inventory)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert schema.names == ["id", *(f"c{i}" for i in range(1000))]
    assert len(sc.statusTracker().getJobIdsForGroup("schemas")) <= 3


def test_files_whose_integers_meet_fractions_are_read_as_sets(spark, tmp_path):
    d = str(tmp_path / "d")
    for i in range(30):
        kind = [pa.int64(), pa.float64(), pa.int32()][i % 3]
        put(d, f"{i:02d}.parquet", id=pa.array([i]), v=pa.array([i], kind), n=pa.array([{"w": i, f"only{i}": "x"}]))
    df = read_dataset(spark, f"{d}/*.parquet", mode="merge")
    assert dict(df.dtypes)["v"] == "double" and len(df.schema["n"].dataType.fields) == 31
    assert sorted((r["id"], r["v"], r["n"]["w"]) for r in df.collect()) == [(i, float(i), i) for i in range(30)]
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2


def test_types_that_do_not_meet(spark, tmp_path):
    d = str(tmp_path / "d")
    put(d, "a.parquet", s=pa.array([{"x": 1}]))
    put(d, "b.parquet", s=pa.array([{"x": [1]}]))
    with pytest.raises(SchemaMismatch, match="s.x"):
        merged_schema(spark, file_inventory(spark, f"{d}/*.parquet"))
