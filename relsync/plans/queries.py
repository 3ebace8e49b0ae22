"""Registered queries over the driver's tables, each with an equivalent DuckDB SQL oracle.

Each query derives release snapshots, nested datasets, manifests or ledgers from the
whole tables with DataFrame code and runs one of the library's operators on them, so
its work grows with the tables. The oracle computes the same result independently in
SQL (for the merge: the literal delete-then-upsert formulation).

Derivations used throughout:

* orders, *old release* (the current table): open and finished orders; priority
  "1-URGENT" was still "2-HIGH"; ``o_custkey`` stored as int; an extra column
  ``o_legacy_code`` that the new release no longer has.
* orders, *new release* (staging): open and pending orders, with a new column
  ``o_orderyear``. So finished orders vanish (delete), pending ones appear (insert) and
  urgent open orders change (update).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relsync.functions.versions import VERSION_PATTERN, is_version, newest_first, version_major, \
    version_minor
from relsync.operators.buckets import bucket_digests, compare_buckets
from relsync.operators.checks import Reference, key_report, key_violations, orphan_keys, orphan_rows
from relsync.operators.evolve import align, schema_diff, union_by_name
from relsync.operators.integrity import compare_hashes, known_hashes
from relsync.operators.merge import change_rows, diff_snapshots, kept_rows, merge_counted, merge_snapshot, \
    merge_stats, replace_snapshot, stale_rows
from relsync.operators.projection import project
from relsync.plans import tree_queries
from relsync.plans.ledger import last_success, latest_per_dataset, latest_per_dataset_window
from relsync.plans.release_load import plan_load, reference_report
from relsync.sources.inventory import dataset_of, suggest_specs
from relsync.sources.manifest import last_listing_wins, parse_manifest_lines, path_conflicts, \
    select_dataset
from relsync.sources.parquet import read_dataset
from relsync.spec import DatasetSpec, ForeignKey, Source

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------- snapshots
def orders_new(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    return o.where(F.col("o_orderstatus").isin("O", "P")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority", F.year("o_orderdate").alias("o_orderyear"),
    )


def orders_old(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    return o.where(F.col("o_orderstatus").isin("F", "O")).select(
        "o_orderkey",
        F.col("o_custkey").cast("int").alias("o_custkey"),
        "o_orderstatus", "o_totalprice", "o_orderdate",
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("2-HIGH"))
        .otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.concat("o_orderstatus", F.lit("-"), F.col("o_orderkey").cast("string"))
        .alias("o_legacy_code"),
    )


SQL_ORDERS_NEW = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS o_orderyear
FROM orders WHERE o_orderstatus IN ('O', 'P')"""

SQL_ORDERS_OLD = """SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus, o_totalprice,
       o_orderdate,
       CASE WHEN o_orderpriority = '1-URGENT' THEN '2-HIGH' ELSE o_orderpriority END
         AS o_orderpriority,
       o_orderstatus || '-' || CAST(o_orderkey AS VARCHAR) AS o_legacy_code
FROM orders WHERE o_orderstatus IN ('F', 'O')"""

SQL_ORDERS = f"""
s AS ({SQL_ORDERS_NEW}),
f AS ({SQL_ORDERS_OLD})"""

# DuckDB type names and the Spark type names they correspond to.
DUCK_TO_SPARK_TYPE = {
    "BIGINT": "bigint", "INTEGER": "int", "SMALLINT": "smallint", "TINYINT": "tinyint",
    "VARCHAR": "string", "DOUBLE": "double", "FLOAT": "float", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz", "TIMESTAMP WITH TIME ZONE": "timestamp", "DATE": "date",
}


def _spark_type_sql(col: str) -> str:
    arms = " ".join(f"WHEN '{d}' THEN '{t}'" for d, t in DUCK_TO_SPARK_TYPE.items())
    return f"CASE {col} {arms} ELSE lower({col}) END"


def conversations_new(spark, d) -> DataFrame:
    c = table(spark, d, "conversations")
    return c.where(F.col("role").isin("user", "assistant")).select("conv_id", "turn", "role", "text")


def conversations_old(spark, d) -> DataFrame:
    c = table(spark, d, "conversations")
    edited = (F.col("role") == "user") & (F.col("turn") >= 3)
    return c.where(F.col("role").isin("system", "user")).select(
        "conv_id", "turn", "role",
        F.when(edited, F.concat("text", F.lit(" [v1]"))).otherwise(F.col("text")).alias("text"),
    )


SQL_CONVERSATIONS = """
s AS (SELECT conv_id, turn, role, text FROM conversations WHERE role IN ('user', 'assistant')),
f AS (SELECT conv_id, turn, role,
             CASE WHEN role = 'user' AND turn >= 3 THEN text || ' [v1]' ELSE text END AS text
      FROM conversations WHERE role IN ('system', 'user'))"""


def ledger_from_events(spark, d) -> DataFrame:
    """A load ledger: event type as dataset, event time as load time, day as release."""
    e = table(spark, d, "events")
    return e.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.col("ts").alias("load_timestamp"),
        F.format_string("24.%02d", F.dayofmonth("ts")).alias("version"),
        F.col("event_type").alias("dataset_name"),
        F.col("user_id").alias("rows_loaded"),
        F.when(F.col("value") < 5, F.lit("failure")).otherwise(F.lit("success")).alias("status"),
    )


SQL_LEDGER = """
ledger AS (SELECT CAST(event_id AS VARCHAR) AS run_id, ts AS load_timestamp,
                  '24.' || lpad(CAST(day(ts) AS VARCHAR), 2, '0') AS version,
                  event_type AS dataset_name, user_id AS rows_loaded,
                  CASE WHEN value < 5 THEN 'failure' ELSE 'success' END AS status
           FROM events)"""


def manifest_lines(spark, d) -> DataFrame:
    """Manifest text made from documents: hash of the text, then the file's relative path.

    German documents use a tab as separator; Spanish ones have a space in the file name;
    documents of src1 carry a leading "./".
    """
    doc = table(spark, d, "documents")
    sep = F.when(F.col("lang") == "de", F.lit("\t")).otherwise(F.lit("  "))
    lead = F.when(F.col("source") == "src1", F.lit("./")).otherwise(F.lit(""))
    name = F.when(F.col("lang") == "es", F.lit("part ")).otherwise(F.lit("part-"))
    return doc.select(
        F.concat(F.sha1("text"), sep, lead, F.lit("output/etl/parquet/"), F.col("source"),
                 F.lit("/"), name, F.col("doc_id").cast("string"), F.lit(".parquet"))
        .alias("value")
    )


SQL_MANIFEST_LINES = r"""
lines AS (SELECT sha1(text)
                 || CASE WHEN lang = 'de' THEN chr(9) ELSE '  ' END
                 || CASE WHEN source = 'src1' THEN './' ELSE '' END
                 || 'output/etl/parquet/' || source || '/'
                 || CASE WHEN lang = 'es' THEN 'part ' ELSE 'part-' END
                 || CAST(doc_id AS VARCHAR) || '.parquet' AS value
          FROM documents),
parsed AS (SELECT regexp_replace(regexp_extract(value, '^\s*(\S+)\s+(.*?)\s*$', 2), '^[./]+', '')
                    AS path,
                  lower(regexp_extract(value, '^\s*(\S+)\s+(.*?)\s*$', 1)) AS sha1
           FROM lines WHERE trim(value) <> '')"""


# --------------------------------------------------------------------------- queries
def q_merge_delta_orders(spark, d):
    return merge_snapshot(orders_new(spark, d), orders_old(spark, d), ["o_orderkey"])


def q_merge_composite_conversations(spark, d):
    return merge_snapshot(conversations_new(spark, d), conversations_old(spark, d),
                          ["conv_id", "turn"])


def _supplier_pairs(spark, d, cond) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.where(cond).select("l_partkey", "l_suppkey").distinct()


def q_merge_all_key_columns(spark, d):
    """Every pair of the table against those returned once, the flag kept from the old table."""
    new = _supplier_pairs(spark, d, F.lit(True))
    old = _supplier_pairs(spark, d, F.col("l_returnflag") == "R").withColumn("returned", F.lit("R"))
    return merge_snapshot(new, old, ["l_partkey", "l_suppkey"])


def q_full_refresh_orders(spark, d):
    return replace_snapshot(orders_new(spark, d), ["o_orderkey"])


def q_diff_digest_orders(spark, d):
    return diff_snapshots(orders_new(spark, d), orders_old(spark, d), ["o_orderkey"],
                          compare="digest")


ORDERS_SPEC = DatasetSpec(
    "orders", primary_key=("o_orderkey",),
    overrides={"o_orderkey": {"rename": "order_id"}, "status": {"action": "flatten"}},
)


def q_delta_load_orders(spark, d):
    """A nested new release of orders, projected by rules and merged into the table of
    the previous release (which still has ``o_legacy_code``)."""
    o = table(spark, d, "orders")
    raw = o.where(F.col("o_orderstatus").isin("O", "P")).select(
        "o_orderkey", "o_custkey",
        F.struct(F.col("o_orderstatus").alias("code"),
                 F.col("o_orderpriority").alias("priority")).alias("status"),
        "o_totalprice", "o_orderdate",
        F.array("o_orderstatus", "o_orderpriority").alias("tags"),
    )
    current = o.where(F.col("o_orderstatus").isin("F", "O")).select(
        F.col("o_orderkey").alias("order_id"), "o_custkey",
        F.col("o_orderstatus").alias("status_code"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("2-HIGH"))
        .otherwise(F.col("o_orderpriority")).alias("status_priority"),
        "o_totalprice", "o_orderdate",
        F.to_json(F.array("o_orderstatus", "o_orderpriority")).alias("tags"),
        F.concat("o_orderstatus", F.lit("-"), F.col("o_orderkey").cast("string"))
        .alias("o_legacy_code"),
    )
    return plan_load(raw, ORDERS_SPEC, current)


def q_stale_rows_orders(spark, d):
    return stale_rows(orders_old(spark, d), orders_new(spark, d), ["o_orderkey"])


def q_kept_rows_orders(spark, d):
    return kept_rows(orders_old(spark, d), orders_new(spark, d), ["o_orderkey"])


def q_diff_snapshots_orders(spark, d):
    return diff_snapshots(orders_new(spark, d), orders_old(spark, d), ["o_orderkey"])


def q_merge_stats_orders(spark, d):
    return merge_stats(orders_new(spark, d), orders_old(spark, d), ["o_orderkey"])


def q_diff_snapshots_conversations(spark, d):
    return diff_snapshots(conversations_new(spark, d), conversations_old(spark, d),
                          ["conv_id", "turn"])


def q_schema_diff_orders(spark, d):
    return schema_diff(spark, orders_new(spark, d), orders_old(spark, d), counts=True)


def q_align_orders(spark, d):
    return align(orders_old(spark, d), orders_new(spark, d).schema)


def q_union_by_name_events(spark, d):
    e = table(spark, d, "events")
    a = e.where(F.col("event_type").isin("view", "click")).select(
        "event_id", "ts", "user_id", "event_type", "value")
    b = e.where(~F.col("event_type").isin("view", "click")).select(
        "event_id", "ts", "user_id", "event_type", "props")
    return union_by_name([a, b])


def _customer_nested(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(
        "c_custkey", "c_name",
        F.struct("n_nationkey", "n_name", "n_regionkey").alias("nation"),
        "c_acctbal", "c_mktsegment",
    )


def q_flatten_customer(spark, d):
    spec = DatasetSpec(
        "customer", primary_key=("c_custkey",), sep="__",
        overrides={"c_custkey": {"rename": "customer_id"},
                   "nation": {"action": "flatten", "rename": "nat"}},
    )
    return project(_customer_nested(spark, d), spec)


def q_struct_json_customer(spark, d):
    c = table(spark, d, "customer")
    info = F.struct(
        F.col("c_name").alias("name"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"),
        F.col("c_nationkey").alias("nationkey"),
    )
    nested = c.select("c_custkey", info.alias("info"))
    return project(nested, DatasetSpec("customer", ("c_custkey",),
                                       overrides={"info": {"action": "json"}}))


def q_list_json_orders(spark, d):
    o = table(spark, d, "orders")
    tags = F.array(
        F.col("o_orderstatus"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")),
    )
    refs = F.array(
        F.struct(F.lit("customer").alias("source"), F.array("o_custkey").alias("ids")),
        F.struct(F.lit("order").alias("source"), F.array("o_orderkey", "o_custkey").alias("ids")),
    )
    nested = o.select("o_orderkey", tags.alias("tags"), refs.alias("refs"))
    return project(nested, DatasetSpec("orders", ("o_orderkey",)))


def q_project_rules_customer(spark, d):
    spec = DatasetSpec(
        "customer", primary_key=("c_custkey",),
        overrides={"c_custkey": {"rename": "customer_id"},
                   "customer_id": {"type": "INTEGER"},
                   "c_name": {"type": "VARCHAR(25)"},
                   "c_mktsegment": {"rename": "segment", "action": "json"}},
    )
    return project(table(spark, d, "customer"), spec)


def q_canonical_types_embeddings(spark, d):
    """int -> bigint, float -> double through its text, for every component of every vector."""
    e = table(spark, d, "embeddings")
    src = e.select("vec_id", "label", F.posexplode("embedding").alias("i", "component"))
    return project(src, DatasetSpec("embeddings", ("vec_id", "i")))


def q_list_json_embeddings(spark, d):
    """Whole float vectors to JSON; the text is read back, so that numbers compare by value
    (JSON writers differ in notation)."""
    out = project(table(spark, d, "embeddings"), DatasetSpec("embeddings", ("vec_id",)))
    values = F.from_json("embedding", "array<double>")
    return out.select("vec_id", F.posexplode(values).alias("i", "value"))


def _instants(spark, d) -> DataFrame:
    """Events at instants of odd microseconds."""
    return table(spark, d, "events").select("event_id", (F.col("event_id") * 1_000_003 + 7).alias("micros"))


def q_canonical_types_zoned(spark, d):
    """A zoned timestamp becomes its UTC wall clock, whatever the session's zone."""
    src = _instants(spark, d).select("event_id", F.timestamp_micros("micros").alias("at"))
    return project(src, DatasetSpec("events", ("event_id",)))


def q_struct_json_times(spark, d):
    """Times inside structs and lists keep their microseconds as JSON."""
    at = F.timestamp_micros("micros")
    src = _instants(spark, d).select("event_id", F.struct(at.alias("at"), "event_id").alias("s"), F.array(at, at).alias("l"))
    return project(src, DatasetSpec("events", ("event_id",)))


def q_diff_digest_times(spark, d):
    """Rows whose only difference is one microsecond, inside a struct too."""
    def side(shift):
        at = F.timestamp_micros(F.col("micros") + shift)
        return _instants(spark, d).select("event_id", at.alias("at"), F.struct(at.alias("at")).alias("s"))

    new = side(F.when(F.col("event_id") % 3 == 0, 1).otherwise(0))
    return diff_snapshots(new, side(F.lit(0)), ["event_id"], compare="digest")


def q_scan_strict_lineitem(spark, d):
    """The scan of a load: first file's schema, footer check, whole table."""
    return read_dataset(spark, f"{d.rstrip('/')}/lineitem.parquet", mode="strict")


def q_scan_merge_events(spark, d):
    """The scan of a load with the files' columns merged at their widest types."""
    return read_dataset(spark, f"{d.rstrip('/')}/events.parquet", mode="merge")


def q_pk_duplicates_lineitem(spark, d):
    return key_violations(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_pk_nulls_documents(spark, d):
    doc = table(spark, d, "documents")
    lab = table(spark, d, "labels")
    labelled = doc.join(lab, "doc_id", "left").select("doc_id", "quality", "toxic", "lang")
    return key_violations(labelled, ["doc_id", "quality"])


def q_fk_orphans_lineitem(spark, d):
    li = table(spark, d, "lineitem")
    parents = table(spark, d, "orders").where(F.col("o_orderstatus") != "F")
    return orphan_keys(li, parents, ["l_orderkey"], ["o_orderkey"])


def q_fk_orphan_rows_lineitem(spark, d):
    li = table(spark, d, "lineitem")
    parents = table(spark, d, "orders").where(F.col("o_orderstatus") != "F")
    return orphan_rows(li, parents, ["l_orderkey"], ["o_orderkey"])


def q_key_report_lineitem(spark, d):
    """All keys of lineitem at once: its primary key, one that repeats, and three references into
    tables that lack rows."""
    return key_report(
        table(spark, d, "lineitem"), {"line": ("l_orderkey", "l_linenumber"), "part_supplier": ("l_partkey", "l_suppkey")},
        {"order": Reference(("l_orderkey",), table(spark, d, "orders").where("o_orderstatus <> 'F'"), ("o_orderkey",)),
         "part": Reference(("l_partkey",), table(spark, d, "part").where("p_partkey % 10 <> 0"), ("p_partkey",)),
         "supplier": Reference(("l_suppkey",), table(spark, d, "supplier").where("s_acctbal > 0"), ("s_suppkey",))})


#: Two datasets that refer to each other, one of them to itself too.
CIRCLE = [
    DatasetSpec("orders", ("o_orderkey",), foreign_keys=(
        ForeignKey("o_custkey", "customers", "c_custkey"), ForeignKey("o_replaces", "orders", "o_orderkey"))),
    DatasetSpec("customers", ("c_custkey",), foreign_keys=(ForeignKey("c_firstorder", "orders", "o_orderkey"),)),
]


def _circle(spark, d) -> dict[str, DataFrame]:
    """Open and pending orders, some replacing the one before; customers in credit with their first
    order of any status. So each side has rows that the other one lacks."""
    orders = orders_new(spark, d).withColumn("o_replaces", F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderkey") - 1))
    first = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderkey").alias("c_firstorder"))
    customers = table(spark, d, "customer").where("c_acctbal > 0").select("c_custkey", "c_name").join(first, "c_custkey", "left")
    return {"orders": orders, "customers": customers}


def q_fk_cycle_orders(spark, d):
    return reference_report(_circle(spark, d), CIRCLE)


def q_merge_counted_orders(spark, d):
    rows, _ = merge_counted(orders_new(spark, d), orders_old(spark, d), ["o_orderkey"])
    return rows


#: Key buckets of the orders whose changes are looked for.
ORDER_BUCKETS = 256


def _orders_revised(spark, d) -> DataFrame:
    """All orders but a few dropped, a few dearer and a few added."""
    o = table(spark, d, "orders")
    dearer = o.where("o_orderkey % 997 <> 3").withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 512 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return dearer.unionByName(o.where("o_orderkey % 1013 = 0").withColumn("o_orderkey", -F.col("o_orderkey")))


def q_changed_buckets_orders(spark, d):
    keys = ["o_orderkey"]
    return compare_buckets(bucket_digests(_orders_revised(spark, d), keys, ORDER_BUCKETS),
                           bucket_digests(table(spark, d, "orders"), keys, ORDER_BUCKETS))


def q_change_rows_orders(spark, d):
    old = orders_old(spark, d)
    return change_rows(merge_snapshot(orders_new(spark, d), old, ["o_orderkey"]), old, ["o_orderkey"])


def q_last_success_events(spark, d):
    return last_success(ledger_from_events(spark, d), "purchase").select(
        "dataset_name", "version", "load_timestamp", "rows_loaded")


def q_latest_per_dataset_events(spark, d):
    return latest_per_dataset(ledger_from_events(spark, d))


def q_latest_per_dataset_window_events(spark, d):
    return latest_per_dataset_window(ledger_from_events(spark, d))


def _version_candidates(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    return union_by_name([
        o.select(F.date_format("o_orderdate", "yy.MM").alias("version")),
        o.select(F.date_format("o_orderdate", "yyyy.MM").alias("version")),
        o.where(F.col("o_orderstatus") == "P").select(
            F.concat(F.date_format("o_orderdate", "yy.MM"), F.lit("-rc")).alias("version")),
    ])


def q_version_sort_orders(spark, d):
    v = _version_candidates(spark, d).where(is_version(F.col("version"))).distinct()
    return v.select("version", version_major(F.col("version")).alias("major"),
                    version_minor(F.col("version")).alias("minor")
                    ).orderBy(*newest_first(F.col("version")))


def q_latest_version_orders(spark, d):
    return q_version_sort_orders(spark, d).limit(1)


def q_manifest_parse_documents(spark, d):
    return parse_manifest_lines(manifest_lines(spark, d))


def _relisted_lines(spark, d) -> DataFrame:
    """Manifest lines where every document of a source and language lists the same path,
    in document order (a release re-listing one file many times)."""
    doc = table(spark, d, "documents")
    return doc.select(
        F.concat(F.sha1("text"), F.lit("  ./output/etl/parquet/"), F.col("source"), F.lit("/"),
                 F.col("lang"), F.lit(".parquet")).alias("value"),
        F.col("doc_id").alias("line_no"),
    )


def q_manifest_conflicts_documents(spark, d):
    return path_conflicts(parse_manifest_lines(_relisted_lines(spark, d)))


def q_manifest_last_wins_documents(spark, d):
    parsed = parse_manifest_lines(_relisted_lines(spark, d), keep=("line_no",))
    return last_listing_wins(parsed, "line_no")


def q_manifest_select_documents(spark, d):
    source = Source("/releases")
    return select_dataset(parse_manifest_lines(manifest_lines(spark, d)), source, "src1")


def q_manifest_verify_documents(spark, d):
    """Files = documents (content = text); manifest with planted faults: German texts
    listed with a wrong hash, src3 not listed, benchmark items listed but absent."""
    doc = table(spark, d, "documents")
    path = F.concat(F.lit("output/etl/parquet/"), F.col("source"), F.lit("/doc-"),
                    F.col("doc_id").cast("string"), F.lit(".txt"))
    files = doc.select(path.alias("path"), F.sha1("text").alias("sha1"))
    listed = doc.where(F.col("source") != "src3").select(
        path.alias("path"),
        F.when(F.col("lang") == "de", F.sha1(F.concat("text", F.lit("#"))))
        .otherwise(F.sha1("text")).alias("sha1"),
    )
    bench = table(spark, d, "benchmark").select(
        F.concat(F.lit("output/etl/parquet/benchmark/item-"), F.col("item_id").cast("string"),
                 F.lit(".txt")).alias("path"),
        F.sha1("text").alias("sha1"),
    )
    return compare_hashes(files, listed.unionByName(bench))


def q_hash_decision_documents(spark, d):
    """Files = documents, their time from the id. Remembered: src3 never; every third with another
    length; every fifth once as it is and later at another time; the others as they are."""
    doc = table(spark, d, "documents").where("text IS NOT NULL")
    hour = F.make_dt_interval(hours=F.col("doc_id") % 1000)
    files = doc.select(F.concat("source", F.lit("/"), "doc_id").alias("path"), F.octet_length("text").cast("long").alias("length"),
                       (F.lit("2024-01-01 00:00:00").cast("timestamp") + hour).alias("modificationTime"), "doc_id", "source", F.sha1("text").alias("sha1"))
    first = files.where("source <> 'src3'").select(
        "path", F.when(F.col("doc_id") % 3 == 0, F.col("length") + 1).otherwise(F.col("length")).alias("length"), "modificationTime", "sha1",
        F.lit("2024-06-01 00:00:00").cast("timestamp").alias("hashed_at"))
    later = files.where("source <> 'src3' AND doc_id % 5 = 0").select(
        "path", "length", (F.col("modificationTime") + F.make_dt_interval(secs=F.lit(1))).alias("modificationTime"), "sha1",
        F.lit("2024-06-02 00:00:00").cast("timestamp").alias("hashed_at"))
    return known_hashes(files.select("path", "length", "modificationTime"), first.unionByName(later)).select("path", "length", "sha1")


def q_spec_suggest_documents(spark, d):
    doc = table(spark, d, "documents")
    paths = doc.select(
        F.concat(F.lit("file:/releases/25.06/output/etl/parquet/"), F.col("source"), F.lit("-"),
                 F.col("lang"), F.lit("/part-"), F.col("doc_id").cast("string"),
                 F.lit(".parquet")).alias("path"))
    datasets = paths.select(dataset_of(F.col("path")).alias("dataset")).distinct()
    return suggest_specs(datasets)


QUERIES: dict[str, Query] = {
    "merge_delta_orders": q_merge_delta_orders,
    "merge_composite_conversations": q_merge_composite_conversations,
    "merge_all_key_columns": q_merge_all_key_columns,
    "full_refresh_orders": q_full_refresh_orders,
    "delta_load_orders": q_delta_load_orders,
    "stale_rows_orders": q_stale_rows_orders,
    "kept_rows_orders": q_kept_rows_orders,
    "diff_snapshots_orders": q_diff_snapshots_orders,
    "diff_snapshots_conversations": q_diff_snapshots_conversations,
    "diff_digest_orders": q_diff_digest_orders,
    "merge_stats_orders": q_merge_stats_orders,
    "merge_counted_orders": q_merge_counted_orders,
    "changed_buckets_orders": q_changed_buckets_orders,
    "change_rows_orders": q_change_rows_orders,
    "schema_diff_orders": q_schema_diff_orders,
    "align_orders": q_align_orders,
    "union_by_name_events": q_union_by_name_events,
    "flatten_customer": q_flatten_customer,
    "struct_json_customer": q_struct_json_customer,
    "list_json_orders": q_list_json_orders,
    "project_rules_customer": q_project_rules_customer,
    "canonical_types_embeddings": q_canonical_types_embeddings,
    "list_json_embeddings": q_list_json_embeddings,
    "canonical_types_zoned": q_canonical_types_zoned,
    "struct_json_times": q_struct_json_times,
    "diff_digest_times": q_diff_digest_times,
    "scan_strict_lineitem": q_scan_strict_lineitem,
    "scan_merge_events": q_scan_merge_events,
    "pk_duplicates_lineitem": q_pk_duplicates_lineitem,
    "pk_nulls_documents": q_pk_nulls_documents,
    "fk_orphans_lineitem": q_fk_orphans_lineitem,
    "fk_orphan_rows_lineitem": q_fk_orphan_rows_lineitem,
    "fk_cycle_orders": q_fk_cycle_orders,
    "key_report_lineitem": q_key_report_lineitem,
    "last_success_events": q_last_success_events,
    "latest_per_dataset_events": q_latest_per_dataset_events,
    "latest_per_dataset_window_events": q_latest_per_dataset_window_events,
    "version_sort_orders": q_version_sort_orders,
    "latest_version_orders": q_latest_version_orders,
    "manifest_parse_documents": q_manifest_parse_documents,
    "manifest_select_documents": q_manifest_select_documents,
    "manifest_conflicts_documents": q_manifest_conflicts_documents,
    "manifest_last_wins_documents": q_manifest_last_wins_documents,
    "manifest_verify_documents": q_manifest_verify_documents,
    "hash_decision_documents": q_hash_decision_documents,
    "spec_suggest_documents": q_spec_suggest_documents,
}


# --------------------------------------------------------------------------- oracles
_MERGE_ORDERS_SQL = f"""
WITH {SQL_ORDERS}
SELECT f.o_orderkey, CAST(s.o_custkey AS INTEGER) AS o_custkey, s.o_orderstatus, s.o_totalprice,
       s.o_orderdate, s.o_orderpriority, f.o_legacy_code, s.o_orderyear
FROM f JOIN s ON s.o_orderkey = f.o_orderkey
UNION ALL
SELECT s.o_orderkey, CAST(s.o_custkey AS INTEGER), s.o_orderstatus, s.o_totalprice,
       s.o_orderdate, s.o_orderpriority, CAST(NULL AS VARCHAR), s.o_orderyear
FROM s WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.o_orderkey = s.o_orderkey)
"""

_DIFF_ORDERS_SQL = f"""
WITH {SQL_ORDERS},
d AS (
  SELECT COALESCE(s.o_orderkey, f.o_orderkey) AS o_orderkey,
         CASE WHEN f.o_orderkey IS NULL THEN 'insert'
              WHEN s.o_orderkey IS NULL THEN 'delete'
              WHEN CAST(s.o_custkey AS INTEGER) IS NOT DISTINCT FROM f.o_custkey
               AND s.o_orderstatus IS NOT DISTINCT FROM f.o_orderstatus
               AND s.o_totalprice IS NOT DISTINCT FROM f.o_totalprice
               AND s.o_orderdate IS NOT DISTINCT FROM f.o_orderdate
               AND s.o_orderpriority IS NOT DISTINCT FROM f.o_orderpriority THEN 'unchanged'
              ELSE 'update' END AS op
  FROM s FULL OUTER JOIN f ON s.o_orderkey = f.o_orderkey)
"""

ORACLES: dict[str, str] = {
    "merge_delta_orders": _MERGE_ORDERS_SQL,
    "merge_composite_conversations": f"""
WITH {SQL_CONVERSATIONS}
SELECT f.conv_id, f.turn, s.role, s.text
FROM f JOIN s ON s.conv_id = f.conv_id AND s.turn = f.turn
UNION ALL
SELECT s.conv_id, s.turn, s.role, s.text FROM s
WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.conv_id = s.conv_id AND f.turn = s.turn)
""",
    "merge_all_key_columns": """
WITH s AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem),
     f AS (SELECT DISTINCT l_partkey, l_suppkey, 'R' AS returned FROM lineitem WHERE l_returnflag = 'R')
SELECT f.l_partkey, f.l_suppkey, f.returned FROM f
WHERE EXISTS (SELECT 1 FROM s WHERE s.l_partkey = f.l_partkey AND s.l_suppkey = f.l_suppkey)
UNION ALL
SELECT s.l_partkey, s.l_suppkey, NULL FROM s
WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.l_partkey = s.l_partkey AND f.l_suppkey = s.l_suppkey)
""",
    "delta_load_orders": """
WITH s AS (SELECT o_orderkey AS order_id, o_custkey, o_orderstatus AS status_code,
                  o_orderpriority AS status_priority, o_totalprice, o_orderdate,
                  to_json([o_orderstatus, o_orderpriority])::VARCHAR AS tags
           FROM orders WHERE o_orderstatus IN ('O', 'P')),
     f AS (SELECT o_orderkey AS order_id, o_orderstatus || '-' || CAST(o_orderkey AS VARCHAR) AS o_legacy_code
           FROM orders WHERE o_orderstatus IN ('F', 'O'))
SELECT s.order_id, s.o_custkey, s.status_code, s.status_priority, s.o_totalprice, s.o_orderdate,
       s.tags, f.o_legacy_code
FROM f JOIN s ON s.order_id = f.order_id
UNION ALL
SELECT s.order_id, s.o_custkey, s.status_code, s.status_priority, s.o_totalprice, s.o_orderdate,
       s.tags, CAST(NULL AS VARCHAR)
FROM s WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.order_id = s.order_id)
""",
    "full_refresh_orders": f"""
WITH {SQL_ORDERS}
SELECT * FROM s
""",
    "stale_rows_orders": f"""
WITH {SQL_ORDERS}
SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = f.o_orderkey)
""",
    "kept_rows_orders": f"""
WITH {SQL_ORDERS}
SELECT * FROM f WHERE EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = f.o_orderkey)
""",
    "diff_snapshots_orders": _DIFF_ORDERS_SQL + "SELECT o_orderkey, op FROM d",
    "diff_snapshots_conversations": f"""
WITH {SQL_CONVERSATIONS}
SELECT COALESCE(s.conv_id, f.conv_id) AS conv_id, COALESCE(s.turn, f.turn) AS turn,
       CASE WHEN f.conv_id IS NULL THEN 'insert'
            WHEN s.conv_id IS NULL THEN 'delete'
            WHEN s.role IS NOT DISTINCT FROM f.role AND s.text IS NOT DISTINCT FROM f.text
              THEN 'unchanged'
            ELSE 'update' END AS op
FROM s FULL OUTER JOIN f ON s.conv_id = f.conv_id AND s.turn = f.turn
""",
    "merge_stats_orders": _DIFF_ORDERS_SQL + "SELECT op, count(*) AS n FROM d GROUP BY op",
    "schema_diff_orders": f"""
WITH sd AS (SELECT column_name, column_type FROM (DESCRIBE {SQL_ORDERS_NEW})),
     fd AS (SELECT column_name, column_type FROM (DESCRIBE {SQL_ORDERS_OLD})),
     sc AS (UNPIVOT (SELECT count(COLUMNS(*)) FROM ({SQL_ORDERS_NEW}))
            ON COLUMNS(*) INTO NAME column_name VALUE staging_non_null),
     fc AS (UNPIVOT (SELECT count(COLUMNS(*)) FROM ({SQL_ORDERS_OLD}))
            ON COLUMNS(*) INTO NAME column_name VALUE final_non_null)
SELECT COALESCE(sd.column_name, fd.column_name) AS "column",
       CASE WHEN fd.column_name IS NULL THEN 'added'
            WHEN sd.column_name IS NULL THEN 'removed'
            WHEN sd.column_type = fd.column_type THEN 'same'
            ELSE 'type_changed' END AS status,
       {_spark_type_sql("sd.column_type")} AS staging_type,
       {_spark_type_sql("fd.column_type")} AS final_type,
       sc.staging_non_null, fc.final_non_null
FROM sd FULL OUTER JOIN fd ON sd.column_name = fd.column_name
LEFT JOIN sc ON sc.column_name = COALESCE(sd.column_name, fd.column_name)
LEFT JOIN fc ON fc.column_name = COALESCE(sd.column_name, fd.column_name)
""",
    "align_orders": f"""
WITH {SQL_ORDERS}
SELECT f.*, CAST(NULL AS INTEGER) AS o_orderyear FROM f
""",
    "union_by_name_events": """
SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_type IN ('view', 'click')
UNION ALL BY NAME
SELECT event_id, ts, user_id, event_type, props FROM events
WHERE event_type NOT IN ('view', 'click')
""",
    "flatten_customer": """
SELECT c.c_custkey AS customer_id, c.c_name,
       CAST(n.n_nationkey AS BIGINT) AS nat__n_nationkey, n.n_name AS nat__n_name,
       CAST(n.n_regionkey AS BIGINT) AS nat__n_regionkey, c.c_acctbal, c.c_mktsegment
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
""",
    "struct_json_customer": """
SELECT c_custkey,
       to_json({'name': c_name,
                'segment': CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END,
                'nationkey': c_nationkey})::VARCHAR AS info
FROM customer
""",
    "list_json_orders": """
SELECT o_orderkey,
       to_json([o_orderstatus,
                CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END])::VARCHAR AS tags,
       to_json([{'source': 'customer', 'ids': [o_custkey]},
                {'source': 'order', 'ids': [o_orderkey, o_custkey]}])::VARCHAR AS refs
FROM orders
""",
    "project_rules_customer": """
SELECT CAST(c_custkey AS INTEGER) AS customer_id, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
       c_acctbal, c_mktsegment AS segment
FROM customer
""",
    "canonical_types_embeddings": """
WITH e AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
SELECT vec_id, CAST(label AS BIGINT) AS label, i, CAST(CAST(x AS VARCHAR) AS DOUBLE) AS component FROM e
""",
    "list_json_embeddings": """
WITH e AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
SELECT vec_id, CAST(i AS INTEGER) AS i, CAST(x AS DOUBLE) AS value FROM e
""",
    "canonical_types_zoned": """
SELECT event_id, make_timestamp(event_id * 1000003 + 7) AS at FROM events
""",
    "struct_json_times": """
WITH t AS (SELECT event_id, strftime(make_timestamp(event_id * 1000003 + 7), '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS utc FROM events)
SELECT event_id, '{"at":"' || utc || '","event_id":' || event_id || '}' AS s, '["' || utc || '","' || utc || '"]' AS l FROM t
""",
    "diff_digest_times": """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'update' ELSE 'unchanged' END AS op FROM events
""",
    "scan_strict_lineitem": "SELECT * FROM lineitem",
    "scan_merge_events": "SELECT * FROM events",
    "pk_duplicates_lineitem": """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 'null_key'
            ELSE 'duplicate_key' END AS reason,
       count(*) AS n
FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL
""",
    "pk_nulls_documents": """
WITH labelled AS (SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT doc_id, quality,
       CASE WHEN doc_id IS NULL OR quality IS NULL THEN 'null_key' ELSE 'duplicate_key' END AS reason,
       count(*) AS n
FROM labelled GROUP BY doc_id, quality
HAVING count(*) > 1 OR doc_id IS NULL OR quality IS NULL
""",
    "fk_orphans_lineitem": """
SELECT l_orderkey, count(*) AS n FROM lineitem l
WHERE l_orderkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus <> 'F' AND o.o_orderkey = l.l_orderkey)
GROUP BY l_orderkey
""",
    "changed_buckets_orders": f"""
WITH f AS (SELECT CAST('0x' || substr(md5('["' || o_orderkey || '"]'), 1, 15) AS BIGINT) % {ORDER_BUCKETS} AS bucket, * FROM orders),
n AS (SELECT * REPLACE (o_totalprice + CASE WHEN o_orderkey % 512 = 0 THEN 1 ELSE 0 END AS o_totalprice) FROM orders
      WHERE o_orderkey % 997 <> 3
      UNION ALL SELECT * REPLACE (-o_orderkey AS o_orderkey) FROM orders WHERE o_orderkey % 1013 = 0),
s AS (SELECT CAST('0x' || substr(md5('["' || o_orderkey || '"]'), 1, 15) AS BIGINT) % {ORDER_BUCKETS} AS bucket, * FROM n),
differs AS ((SELECT * FROM s EXCEPT SELECT * FROM f) UNION ALL (SELECT * FROM f EXCEPT SELECT * FROM s))
SELECT CAST(bucket AS INTEGER) AS bucket, COALESCE(rows_new, 0) AS rows_new, COALESCE(rows_old, 0) AS rows_old,
       bucket IN (SELECT bucket FROM differs) AS changed
FROM (SELECT bucket, count(*) AS rows_new FROM s GROUP BY bucket)
FULL OUTER JOIN (SELECT bucket, count(*) AS rows_old FROM f GROUP BY bucket) USING (bucket)
""",
    "change_rows_orders": f"""
WITH {SQL_ORDERS}
SELECT CASE WHEN f.o_orderkey IS NULL THEN 'insert' ELSE 'update' END AS op,
       s.o_orderkey, CAST(s.o_custkey AS INTEGER) AS o_custkey, s.o_orderstatus, s.o_totalprice, s.o_orderdate,
       s.o_orderpriority, f.o_legacy_code, s.o_orderyear
FROM s LEFT JOIN f ON s.o_orderkey = f.o_orderkey
-- a kept row changes at least in the column that it did not have
WHERE f.o_orderkey IS NULL OR s.o_orderyear IS NOT NULL OR s.o_orderpriority <> f.o_orderpriority
UNION ALL
SELECT 'delete', f.o_orderkey, f.o_custkey, f.o_orderstatus, f.o_totalprice, f.o_orderdate, f.o_orderpriority,
       f.o_legacy_code, NULL
FROM f WHERE f.o_orderkey NOT IN (SELECT o_orderkey FROM s)
""",
    "hash_decision_documents": """
SELECT source || '/' || doc_id AS path, octet_length(encode(text)) AS length,
       CASE WHEN source <> 'src3' AND doc_id % 3 <> 0 AND doc_id % 5 <> 0 THEN sha1(text) END AS sha1
FROM documents WHERE text IS NOT NULL
""",
    "key_report_lineitem": """
SELECT 'line' AS "check", 'duplicate_key' AS reason, '["' || l_orderkey || '","' || l_linenumber || '"]' AS key, count(*) AS n
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL
SELECT 'part_supplier', 'duplicate_key', '["' || l_partkey || '","' || l_suppkey || '"]', count(*)
FROM lineitem GROUP BY l_partkey, l_suppkey HAVING count(*) > 1
UNION ALL
SELECT 'order', 'orphan', '["' || l_orderkey || '"]', count(*) FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F') GROUP BY l_orderkey
UNION ALL
SELECT 'part', 'orphan', '["' || l_partkey || '"]', count(*) FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 10 <> 0) GROUP BY l_partkey
UNION ALL
SELECT 'supplier', 'orphan', '["' || l_suppkey || '"]', count(*) FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY l_suppkey
""",
    "fk_cycle_orders": f"""
WITH o AS (SELECT *, CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey - 1 END AS o_replaces FROM ({SQL_ORDERS_NEW})),
c AS (SELECT c_custkey, (SELECT min(o_orderkey) FROM orders WHERE o_custkey = c_custkey) AS c_firstorder
      FROM customer WHERE c_acctbal > 0)
SELECT 'orders' AS "table", 'o_custkey' AS foreign_key, 'customers' AS parent, '["' || o_custkey || '"]' AS key, count(*) AS n
FROM o WHERE o_custkey NOT IN (SELECT c_custkey FROM c) GROUP BY o_custkey
UNION ALL
SELECT 'orders', 'o_replaces', 'orders', '["' || o_replaces || '"]', count(*)
FROM o WHERE o_replaces IS NOT NULL AND o_replaces NOT IN (SELECT o_orderkey FROM o) GROUP BY o_replaces
UNION ALL
SELECT 'customers', 'c_firstorder', 'orders', '["' || c_firstorder || '"]', count(*)
FROM c WHERE c_firstorder IS NOT NULL AND c_firstorder NOT IN (SELECT o_orderkey FROM o) GROUP BY c_firstorder
""",
    "fk_orphan_rows_lineitem": """
SELECT * FROM lineitem l
WHERE l_orderkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus <> 'F' AND o.o_orderkey = l.l_orderkey)
""",
    "last_success_events": f"""
WITH {SQL_LEDGER}
SELECT dataset_name, version, load_timestamp, rows_loaded FROM ledger
WHERE dataset_name = 'purchase' AND status = 'success'
ORDER BY load_timestamp DESC, run_id DESC LIMIT 1
""",
    "latest_per_dataset_events": f"""
WITH {SQL_LEDGER}
SELECT dataset_name, arg_max(version, (load_timestamp, run_id)) AS version,
       max(load_timestamp) AS load_timestamp, arg_max(rows_loaded, (load_timestamp, run_id)) AS rows_loaded
FROM ledger WHERE status = 'success' GROUP BY dataset_name
""",
    "latest_per_dataset_window_events": f"""
WITH {SQL_LEDGER},
r AS (SELECT *, row_number() OVER (PARTITION BY dataset_name ORDER BY load_timestamp DESC, run_id DESC) AS rn
      FROM ledger WHERE status = 'success')
SELECT dataset_name, version, load_timestamp, rows_loaded FROM r WHERE rn = 1
""",
    "version_sort_orders": rf"""
WITH c AS (
  SELECT strftime(o_orderdate, '%y.%m') AS version FROM orders
  UNION ALL SELECT strftime(o_orderdate, '%Y.%m') FROM orders
  UNION ALL SELECT strftime(o_orderdate, '%y.%m') || '-rc' FROM orders WHERE o_orderstatus = 'P'),
v AS (SELECT DISTINCT version FROM c WHERE regexp_full_match(version, '{VERSION_PATTERN[1:-1]}'))
SELECT version, CAST(split_part(version, '.', 1) AS INTEGER) AS major,
       CAST(split_part(version, '.', 2) AS INTEGER) AS minor
FROM v ORDER BY major DESC, minor DESC
""",
    "manifest_parse_documents": f"WITH {SQL_MANIFEST_LINES} SELECT path, sha1 FROM parsed",
    "manifest_select_documents": f"""WITH {SQL_MANIFEST_LINES}
SELECT path, sha1 FROM parsed WHERE starts_with(path, 'output/etl/parquet/src1/')""",
    "manifest_conflicts_documents": """
WITH lines AS (SELECT sha1(text) AS sha1, 'output/etl/parquet/' || source || '/' || lang || '.parquet' AS path
               FROM documents)
SELECT path, count(*) AS n, count(DISTINCT sha1) AS n_hashes FROM lines
GROUP BY path HAVING count(*) > 1
""",
    "manifest_last_wins_documents": """
WITH lines AS (SELECT sha1(text) AS sha1, 'output/etl/parquet/' || source || '/' || lang || '.parquet' AS path,
                      doc_id FROM documents)
SELECT path, arg_max(sha1, doc_id) AS sha1 FROM lines GROUP BY path
""",
    "manifest_verify_documents": """
WITH files AS (SELECT 'output/etl/parquet/' || source || '/doc-' || CAST(doc_id AS VARCHAR) || '.txt'
                        AS path, sha1(text) AS sha1 FROM documents),
listed AS (
  SELECT 'output/etl/parquet/' || source || '/doc-' || CAST(doc_id AS VARCHAR) || '.txt' AS path,
         CASE WHEN lang = 'de' THEN sha1(text || '#') ELSE sha1(text) END AS sha1
  FROM documents WHERE source <> 'src3'
  UNION ALL
  SELECT 'output/etl/parquet/benchmark/item-' || CAST(item_id AS VARCHAR) || '.txt', sha1(text)
  FROM benchmark)
SELECT COALESCE(f.path, m.path) AS path,
       CASE WHEN m.path IS NULL THEN 'not_in_manifest'
            WHEN f.path IS NULL THEN 'missing_file'
            WHEN f.sha1 = m.sha1 THEN 'ok' ELSE 'mismatch' END AS status,
       m.sha1 AS expected_sha1, f.sha1 AS actual_sha1
FROM files f FULL OUTER JOIN listed m ON f.path = m.path
""",
    "spec_suggest_documents": """
SELECT DISTINCT source || '-' || lang AS dataset, source || '_' || lang AS final_table_name,
       'id' AS primary_key
FROM documents
""",
}

ORACLES["merge_counted_orders"] = ORACLES["merge_delta_orders"]
ORACLES["diff_digest_orders"] = ORACLES["diff_snapshots_orders"]
ORACLES["latest_version_orders"] = ORACLES["version_sort_orders"].rstrip() + " LIMIT 1"

# queries over release trees written from the tables
QUERIES.update(tree_queries.QUERIES)
ORACLES.update(tree_queries.ORACLES)
