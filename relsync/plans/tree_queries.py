"""Registered queries that call the release functions on real trees.

Each writes a release tree of whole tables with DataFrame writes (several files a dataset, manifests
with the files' checksums, planted faults) into the folder that all machines share, and runs the
library's discovery, verification, reading or loading on it. The oracles state the result from the
tables alone.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relsync.operators.integrity import hash_files, verify_files
from relsync.plans.release_load import load_release
from relsync.plans.sink import CatalogSink
from relsync.plans.validate import run_checks
from relsync.sources.files import locate
from relsync.sources.inventory import latest_version, list_data_files, list_datasets, list_versions
from relsync.sources.manifest import load_manifest
from relsync.sources.parquet import footer_report, read_dataset
from relsync.spec import DatasetSpec, Source

#: Slices that every dataset of documents is written in, one file each: stretches of ids, in turn.
SLICES, STRETCH = 4, 20


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder name under the folder that all machines share; a temporary one on one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir (a shared folder)")
        base = tempfile.mkdtemp(prefix="relsync-trees-")
    return f"{base.rstrip('/')}/tree-{uuid.uuid4().hex}"


def _write(path: str, text: str) -> None:
    found, at = locate(path)
    found.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with found.open_output_stream(at) as out:
        out.write(text.encode())


def _tree(root: str) -> Source:
    """Datasets are written by Spark as ``<root>/<version>/dataset=<name>/*.parquet``."""
    return Source(root, data_template=root + "/{version}/dataset={dataset_name}")


def write_datasets(rows: DataFrame, source: Source, version: str) -> None:
    """Append rows (column ``dataset``) to a release: one file per dataset and call."""
    rows.repartition("dataset").write.mode("append").partitionBy("dataset").parquet(source.parquet_root(version))


def write_manifest(spark: SparkSession, source: Source, version: str, lines: DataFrame | None = None) -> None:
    """The manifest of a release (default: every data file) and its checksum file."""
    if lines is None:
        lines = checksum_lines(spark, source, version)
    text = "\n".join(r["value"] for r in lines.orderBy("value").collect()) + "\n"  # one line a file
    _write(source.manifest(version), text)
    _write(source.manifest_hash(version), f"{hashlib.sha1(text.encode()).hexdigest()}  {source.manifest_name}\n")


def checksum_lines(spark: SparkSession, source: Source, version: str) -> DataFrame:
    """``(dataset, value)``: the manifest line of every data file."""
    hashed = hash_files(spark, f"{source.parquet_root(version)}/*/*.parquet")
    dataset = F.regexp_extract("path", "/dataset=([^/]+)/", 1)
    name = F.substring_index("path", "/", -1)
    return hashed.select(dataset.alias("dataset"), F.concat("sha1", F.lit(f"  ./{source.parquet_dir}/"), dataset, F.lit("/"), name).alias("value"))


def _documents(spark, d) -> DataFrame:
    return _table(spark, d, "documents").withColumn("slice", F.floor(F.col("doc_id") / STRETCH) % SLICES)


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.concat(F.lit("plain-"), "source").alias("dataset"), "doc_id", "text", "lang", "n_chars", "slice")


def plain_tree(spark, d) -> Source:
    """Documents by source, in files of equal schema."""
    source, rows = _tree(scratch(spark)), _plain(_documents(spark, d))
    for i in range(SLICES):
        write_datasets(rows.where(F.col("slice") == i).drop("slice"), source, "25.06")
    return source


def mixed_tree(spark, d) -> Source:
    """Documents by source, in files of other schemas: slice 1 has a narrow number, slice 2 a column
    more, slice 3 one less."""
    source = _tree(scratch(spark))
    docs = _documents(spark, d).select(F.concat(F.lit("mixed-"), "source").alias("dataset"), "doc_id", "lang", "n_chars", "slice")
    shapes = [
        lambda x: x, lambda x: x.withColumn("n_chars", F.col("n_chars").cast("int")),
        lambda x: x.withColumn("note", F.concat(F.lit("n"), "doc_id")), lambda x: x.drop("lang"),
    ]
    for i, shape in enumerate(shapes):
        write_datasets(shape(docs.where(F.col("slice") == i).drop("slice")), source, "25.06")
    return source


# --------------------------------------------------------------------------- discovery
def q_tree_versions_orders(spark, d):
    """S1, S2: a release per order month; months of pending orders have no manifest of their own,
    and folders of other names lie beside."""
    source = Source(scratch(spark))
    o = _table(spark, d, "orders")
    month = F.date_format("o_orderdate", "yy.MM")
    names = o.where("o_orderstatus <> 'P'").select(month.alias("name")).unionByName(
        o.select(F.date_format("o_orderdate", "yyyy.MM").alias("name"))).unionByName(
        o.select(F.concat(month, F.lit("-rc")).alias("name"))).distinct()

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name in pdf["name"]:
                _write(source.manifest(name), "0  ./none\n")
            yield pdf

    names.mapInPandas(write, "name string").write.format("noop").mode("overwrite").save()
    newest = latest_version(spark, source)
    return list_versions(spark, source).withColumn("latest", F.col("version") == newest)


def q_tree_datasets_documents(spark, d):
    """S3: the datasets of a release."""
    return list_datasets(spark, plain_tree(spark, d), "25.06")


def q_tree_files_documents(spark, d):
    """S4: the data files of every dataset; a nested folder and other files do not count."""
    source = plain_tree(spark, d)
    out = None
    for r in list_datasets(spark, source, "25.06").collect():  # one row a dataset
        name = r["dataset"].split("=", 1)[1]
        _write(f"{source.dataset_dir('25.06', name)}/notes.txt", "no data")
        _write(f"{source.dataset_dir('25.06', name)}/sub/part-0.parquet", "no data")
        files = list_data_files(spark, source, "25.06", name)
        part = files.groupBy(F.lit(name).alias("dataset")).agg(F.count(F.lit(1)).alias("files"), F.bool_and(F.col("length") > 0).alias("filled"))
        out = part if out is None else out.unionByName(part)
    return out


# --------------------------------------------------------------------------- schemas
def q_tree_footers_documents(spark, d):
    """S5, S6: how every file's columns differ from those of a file of slice 0."""
    source = mixed_tree(spark, d)
    base = _tree(scratch(spark))
    write_datasets(_documents(spark, d).where("slice = 0").select(F.lit("base").alias("dataset"), "doc_id", "lang", "n_chars"), base, "25.06")
    reference = list_data_files(spark, base, "25.06", "base").first()["path"]
    files = hash_files(spark, f"{source.parquet_root('25.06')}/*/*.parquet").select("path")
    report = footer_report(spark, files, reference)
    join = lambda c: F.array_join(c, ",").alias(c)
    return report.select(F.regexp_extract("path", "/dataset=([^/]+)/", 1).alias("dataset"), join("missing"), join("extra"), join("retyped")).groupBy(
        "dataset", "missing", "extra", "retyped").agg(F.count(F.lit(1)).alias("files"))


def q_tree_scan_documents(spark, d):
    """S7: the strict read of all files of a release."""
    source = plain_tree(spark, d)
    return read_dataset(spark, f"{source.parquet_root('25.06')}/*/*.parquet", mode="strict").select("doc_id", "text", "lang", "n_chars")


def q_tree_merged_documents(spark, d):
    """S6, S7: the merged read of files of other schemas."""
    source = mixed_tree(spark, d)
    return read_dataset(spark, f"{source.parquet_root('25.06')}/*/*.parquet", mode="merge").select("doc_id", "lang", "n_chars", "note")


# --------------------------------------------------------------------------- integrity
def q_tree_verified_documents(spark, d):
    """S9 to S11, J6: the manifest is checked, read and compared with the files; src1 is listed with
    other checksums, src2 is not listed, and a file that is listed does not exist."""
    source = plain_tree(spark, d)
    lines = checksum_lines(spark, source, "25.06").where("dataset <> 'plain-src2'").select(
        F.when(F.col("dataset") == "plain-src1", F.regexp_replace("value", "^.", "x")).otherwise(F.col("value")).alias("value"))
    ghosts = _documents(spark, d).select("source").distinct().where("source <> 'src2'").select(
        F.concat(F.lit("0  ./output/etl/parquet/plain-"), "source", F.lit("/ghost.parquet")).alias("value"))
    write_manifest(spark, source, "25.06", lines.unionByName(ghosts))
    manifest = load_manifest(spark, source, "25.06")
    out = None
    for r in list_datasets(spark, source, "25.06").collect():  # one row a dataset
        name = r["dataset"].split("=", 1)[1]
        report = verify_files(hash_files(spark, f"{source.dataset_dir('25.06', name)}/*.parquet"), manifest, source.relative_prefix(name), ".parquet")
        part = report.groupBy(F.lit(name).alias("dataset"), "status").agg(F.count(F.lit(1)).alias("files"))
        out = part if out is None else out.unionByName(part)
    return out


# --------------------------------------------------------------------------- loads
LOAD_SPECS = [DatasetSpec("even", ("doc_id",)), DatasetSpec("odd", ("doc_id",))]


def load_tree(spark, d) -> Source:
    """Two releases of the documents, by parity of the id: the older one lacks slice 3 and has other
    texts of slice 0; the newer one lacks documents divisible by 100."""
    source = _tree(scratch(spark))
    rows = _documents(spark, d).select(F.when(F.col("doc_id") % 2 == 0, "even").otherwise("odd").alias("dataset"), "doc_id", "text", "lang", "slice")
    older = rows.where("slice <> 3").withColumn("text", F.when(F.col("slice") == 0, F.lit("old")).otherwise(F.col("text")))
    for version, content in (("25.03", older), ("25.06", rows.where("doc_id % 100 <> 0"))):
        for i in range(SLICES):
            write_datasets(content.where(F.col("slice") == i).drop("slice"), source, version)
        write_manifest(spark, source, version)
    return source


def q_tree_load_documents(spark, d):
    """D2 to D4, K1 to K7, A1, A2, V3 to V5: pre-flight checks, a first load, a delta load of the next
    release that counts its operations, and a third one that finds nothing to do; then the ledger."""
    source = load_tree(spark, d)
    sink = CatalogSink(spark, database="tree_" + uuid.uuid4().hex[:12])
    try:
        found = [("check", r["check"], None, "success" if r["success"] else "failure", None, None, None, None, None)
                 for r in run_checks(spark, source, LOAD_SPECS, sink=sink).collect()]
        for step, version in (("first", "25.03"), ("delta", None), ("again", None)):
            out = load_release(spark, LOAD_SPECS, source, sink, version=version, statistics=True)
            found += [(step, r["dataset"], r["version"], r["status"], r["rows_loaded"], r["inserted"], r["updated"], r["deleted"], r["unchanged"])
                      for r in out.collect()]
        for r in sink.ledger().collect():
            found.append(("ledger", r["dataset_name"], r["version"], r["status"], r["rows_loaded"], None, None, None, None))
        for spec in LOAD_SPECS:
            found.append(("table", spec.name, None, "read", sink.read(spec.name).count(), None, None, None, None))
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {sink.database} CASCADE")
    return spark.createDataFrame(found, "step string, name string, version string, status string, rows_loaded long, "
                                        "inserted long, updated long, deleted long, unchanged long")


#: Releases of the orders by status, and the releases asked for.
STATUSES = {"22.03": ("F",), "22.06": ("F", "O"), "22.11": ("O", "P")}
ASKED = ("22.03", "22.05", "22.06", "22.10", "22.11", "23.01")


def q_as_of_orders(spark, d):
    """K4, L1: three releases of a table are published, and it is read as of six."""
    orders = _table(spark, d, "orders")
    sink = CatalogSink(spark, database="tree_" + uuid.uuid4().hex[:12], keep_releases=3)
    try:
        for version, statuses in STATUSES.items():
            staged = sink.stage("orders", orders.where(F.col("o_orderstatus").isin(*statuses)), ["o_orderkey"], "delta")
            staged.release = version
            staged.publish()
        found = []
        for version in ASKED:
            r = sink.read_as_of("orders", version).agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("s")).first()
            found.append((version, sink.as_of("orders", version)[1], r["n"], r["s"]))
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {sink.database} CASCADE")
    return spark.createDataFrame(found, "asked string, release string, orders long, custkeys long")


QUERIES = {
    "as_of_orders": q_as_of_orders,
    "tree_versions_orders": q_tree_versions_orders,
    "tree_datasets_documents": q_tree_datasets_documents,
    "tree_files_documents": q_tree_files_documents,
    "tree_footers_documents": q_tree_footers_documents,
    "tree_scan_documents": q_tree_scan_documents,
    "tree_merged_documents": q_tree_merged_documents,
    "tree_verified_documents": q_tree_verified_documents,
    "tree_load_documents": q_tree_load_documents,
}

_LOADED = """
WITH r AS (SELECT CASE WHEN doc_id % 2 = 0 THEN 'even' ELSE 'odd' END AS name, doc_id, text, (doc_id // 20) % 4 AS slice FROM documents),
old AS (SELECT name, doc_id, CASE WHEN slice = 0 THEN 'old' ELSE text END AS text FROM r WHERE slice <> 3),
new AS (SELECT name, doc_id, text FROM r WHERE doc_id % 100 <> 0),
d AS (
  SELECT COALESCE(n.name, o.name) AS name,
         CASE WHEN o.doc_id IS NULL THEN 'i' WHEN n.doc_id IS NULL THEN 'd' WHEN n.text IS DISTINCT FROM o.text THEN 'u' ELSE 'k' END AS op
  FROM new n FULL OUTER JOIN old o USING (doc_id)),
loads AS (
  SELECT 'first' AS step, name, '25.03' AS version, 'loaded' AS status, count(*) AS rows_loaded, CAST(NULL AS BIGINT) AS inserted,
         CAST(NULL AS BIGINT) AS updated, CAST(NULL AS BIGINT) AS deleted, CAST(NULL AS BIGINT) AS unchanged
  FROM old GROUP BY name
  UNION ALL
  SELECT 'delta', name, '25.06', 'loaded', count(*) FILTER (op <> 'd'), count(*) FILTER (op = 'i'), count(*) FILTER (op = 'u'),
         count(*) FILTER (op = 'd'), count(*) FILTER (op = 'k')
  FROM d GROUP BY name)
SELECT * FROM loads
UNION ALL SELECT 'again', name, '25.06', 'skipped_already_loaded', NULL, NULL, NULL, NULL, NULL FROM loads WHERE step = 'first'
UNION ALL SELECT 'ledger', name, version, 'success', rows_loaded, NULL, NULL, NULL, NULL FROM loads
UNION ALL SELECT 'table', name, NULL, 'read', rows_loaded, NULL, NULL, NULL, NULL FROM loads WHERE step = 'delta'
UNION ALL SELECT 'check', UNNEST(['target', 'source', 'datasets']), NULL, 'success', NULL, NULL, NULL, NULL, NULL
"""

ORACLES = {
    "as_of_orders": """
WITH asked AS (SELECT * FROM (VALUES ('22.03', '22.03'), ('22.05', '22.03'), ('22.06', '22.06'), ('22.10', '22.06'),
                                     ('22.11', '22.11'), ('23.01', '22.11')) AS a(asked, release)),
held AS (SELECT * FROM (VALUES ('22.03', 'F'), ('22.06', 'F'), ('22.06', 'O'), ('22.11', 'O'), ('22.11', 'P')) AS h(release, status))
SELECT asked, release, count(*) AS orders, CAST(sum(o_custkey) AS BIGINT) AS custkeys
FROM asked JOIN held USING (release) JOIN orders ON o_orderstatus = status GROUP BY asked, release
""",
    "tree_versions_orders": """
SELECT version, CAST(substr(version, 1, 2) AS INTEGER) AS major, CAST(substr(version, 4, 2) AS INTEGER) AS minor,
       version = max(version) OVER () AS latest
FROM (SELECT DISTINCT strftime(o_orderdate, '%y.%m') AS version FROM orders WHERE o_orderstatus <> 'P')
""",
    "tree_datasets_documents": "SELECT DISTINCT 'dataset=plain-' || source AS dataset FROM documents",
    "tree_files_documents": """
SELECT 'plain-' || source AS dataset, count(DISTINCT (doc_id // 20) % 4) AS files, TRUE AS filled FROM documents GROUP BY source
""",
    "tree_footers_documents": """
SELECT 'mixed-' || source AS dataset, CASE WHEN (doc_id // 20) % 4 = 3 THEN 'lang' ELSE '' END AS missing,
       CASE WHEN (doc_id // 20) % 4 = 2 THEN 'note' ELSE '' END AS extra, '' AS retyped,
       count(DISTINCT (doc_id // 20) % 4) AS files
FROM documents GROUP BY ALL
""",
    "tree_scan_documents": "SELECT doc_id, text, lang, n_chars FROM documents",
    "tree_merged_documents": """
SELECT doc_id, CASE WHEN (doc_id // 20) % 4 <> 3 THEN lang END AS lang, n_chars, CASE WHEN (doc_id // 20) % 4 = 2 THEN 'n' || doc_id END AS note
FROM documents
""",
    "tree_verified_documents": """
WITH f AS (SELECT source, count(DISTINCT (doc_id // 20) % 4) AS files FROM documents GROUP BY source)
SELECT 'plain-' || source AS dataset,
       CASE source WHEN 'src1' THEN 'mismatch' WHEN 'src2' THEN 'not_in_manifest' ELSE 'ok' END AS status, files FROM f
UNION ALL SELECT 'plain-' || source, 'missing_file', 1 FROM f WHERE source <> 'src2'
""",
    "tree_load_documents": _LOADED,
}
