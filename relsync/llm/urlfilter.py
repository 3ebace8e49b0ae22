"""URL filters: rules, and link-graph propagation for the rest (operator 9), DataFrame functions only.

Rules (verdict, host, path) fit a host and its subdomains where the url's path starts with the
rule's; the longest fitting rule wins. Urls that no rule fits are judged by their host's
links. Host edges are counted from the pages' links. Trust is a personalised PageRank from
the hosts of allowed pages along the links, distrust one from the hosts of blocked pages
against them: who links to blocked hosts is distrusted. Only what a host receives through
links counts, since its own ruled pages are judged by their rules. A host is blocked where
distrust is more than ``threshold`` of both together; hosts that receive nothing are allowed.

Scale: pages are read twice, narrow for the verdict and with their links for the edges, which
are counted with partial aggregation before any shuffle, so a host with a third of all pages
is one row per task. Ranks are spread as what was received in the last round only, one
aggregation a round, each round written to the shared checkpoint folder. Rules and ranks come
to the pages by a join with a table of hosts that every task holds while hosts are few, and
that is repeated, with each host's pages dealt over the repetitions, where they are many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relsync.llm.common import cut, lookup

#: Share of rank that is passed on, most rounds, and the rank left in a round that ends them.
DAMPING, ROUNDS, LEAST = 0.85, 20, 1e-9
THRESHOLD = 0.5
# Letters that are lowered in hosts, and the host in an absolute link.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)href[ \t\r\n]*=[ \t\r\n]*["']?[ \t\r\n]*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'> \t\r\n]+)"""

Rules = list[tuple[str, str, str]] | DataFrame


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(F.when(F.instr(url, "://") > 0, host), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)), F.lit(""))


def rule_table(spark: SparkSession, rules: Rules) -> DataFrame:
    """(verdict, host, path) as a table; hosts lowered."""
    if not isinstance(rules, DataFrame):
        listed = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules]
        listed = listed or [F.struct(*[F.lit("").alias(c) for c in ("verdict", "host", "path")])]
        rules = spark.range(1).select(F.inline(F.array(*listed)))
    rules = rules.where("verdict IN ('allow', 'block') AND host <> '' AND path IS NOT NULL")
    return rules.select("verdict", F.translate("host", UPPER, LOWER).alias("host"), "path").distinct()


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): for each of ``hosts`` that any rule may fit, these rules."""
    labels = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0]
    if labels is None:
        return hosts.select("host", F.expr("CAST(NULL AS array<struct<size:int,block:int,rule:string,path:string>>)").alias("rules")).where("false")
    # no rule has more labels than this, so no longer ending of a host can be a rule's host
    endings = F.array_distinct(F.array(*[F.substring_index("host", ".", -i) for i in range(1, labels + 1)]))
    name = F.concat("rule_host", "path")
    entry = F.struct(F.length(name).alias("size"), (F.col("verdict") == "block").cast("int").alias("block"), name.alias("rule"), F.col("path"))
    return (
        hosts.select("host", F.explode(endings).alias("ending"))
        .join(rules.withColumnRenamed("host", "rule_host"), F.col("ending") == F.col("rule_host"))
        .groupBy("host").agg(F.collect_list(entry).alias("rules"))
    )


def fitting_rule(rules: Column, path: Column) -> Column:
    """The longest of ``rules`` whose path ``path`` starts with (of equally long ones a blocking one)."""
    return F.array_max(F.filter(rules, lambda r: F.startswith(path, r["path"])))


def host_edges(pages: DataFrame, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, n): absolute links in the pages' html from a host to another, counted."""
    linked = pages.select(host_of(F.col(url_col)).alias("src"), F.explode(F.regexp_extract_all(html_col, F.lit(LINK), F.lit(1))).alias("dst"))
    linked = linked.select("src", F.translate("dst", UPPER, LOWER).alias("dst"))
    return linked.where("src <> '' AND src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, received): personalised PageRank that hosts receive along ``edges`` (a, b, n) from
    ``seeds`` (host, weight), without the share that seeds have by themselves.

    Seeds' weights are taken as shares of their sum. A host passes on ``damping`` of what it
    has, split by the number of links; what a host without links has goes nowhere.
    """
    degree = edges.groupBy(F.col("a").alias("of")).agg(F.sum("n").alias("all"))
    steps = cut(edges.join(degree, F.col("a") == F.col("of")).select("a", "b", (F.col("n") / F.col("all")).alias("w")))
    total = seeds.agg(F.sum("weight")).first()[0] or 1
    wave = cut(seeds.select("host", ((1 - damping) * F.col("weight") / F.lit(float(total))).alias("x")))
    received = None
    for _ in range(rounds):
        wave = cut(
            steps.join(wave, F.col("a") == F.col("host")).groupBy("b").agg((damping * F.sum(F.col("x") * F.col("w"))).alias("x"))
            .select(F.col("b").alias("host"), "x")
        )
        left = wave.agg(F.sum("x")).first()[0] or 0.0
        if left > 0:
            received = wave if received is None else received.unionByName(wave)
        if left < LEAST:
            break
    if received is None:
        received = wave
    return received.groupBy("host").agg(F.sum("x").alias("received"))


def judge_urls(
    pages: DataFrame, rules: Rules, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule (host and path of the winning rule, else
    null), verdict (allow or block), and the host's trust and distrust received by links.

    Null urls and urls without ``://`` have empty host and path; no rule fits them and nothing
    links to them: allowed. Null or empty html has no links. Repeated rows are all returned
    and their links count each time. Without rules there are no seeds: all allowed. An empty
    table gives an empty result; other columns play no part.
    """
    rules = rule_table(pages.sparkSession, rules)
    narrow = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    hosts = cut(narrow.groupBy("host").agg(F.count(F.lit(1)).alias("pages")))
    fitted = cut(host_rules(hosts, rules))
    of_host = fitted.select(F.col("host").alias("h"), "rules")
    # pages judged by rules, per host: the seeds
    ruled = lookup(narrow, of_host, F.col("host") == F.col("h"), [F.col("id"), F.col("path")]).select("host", fitting_rule(F.col("rules"), F.col("path")).alias("r"))
    counts = cut(ruled.where("r IS NOT NULL").groupBy("host").agg(
        F.sum(F.col("r.block")).alias("blocked"), F.sum(1 - F.col("r.block")).alias("allowed")))
    edges = cut(host_edges(pages, url_col=url_col, html_col=html_col))
    seeds = lambda c: counts.where(F.col(c) > 0).select("host", F.col(c).alias("weight"))
    trust = propagate(edges.select(F.col("src").alias("a"), F.col("dst").alias("b"), "n"), seeds("allowed"))
    distrust = propagate(edges.select(F.col("dst").alias("a"), F.col("src").alias("b"), "n"), seeds("blocked"))
    scored = (
        hosts.join(of_host, F.col("host") == F.col("h"), "left").drop("h")
        .join(trust.select(F.col("host").alias("h"), F.col("received").alias("trust")), F.col("host") == F.col("h"), "left").drop("h")
        .join(distrust.select(F.col("host").alias("h"), F.col("received").alias("distrust")), F.col("host") == F.col("h"), "left")
        .select(F.col("host").alias("h"), "rules", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
    )
    judged = lookup(narrow, cut(scored), F.col("host") == F.col("h"), [F.col("id"), F.col("path")], "left").withColumn("r", fitting_rule(F.col("rules"), F.col("path")))
    by_links = F.col("distrust") > threshold * (F.col("trust") + F.col("distrust"))
    blocked = F.when(F.col("r").isNull(), by_links).otherwise(F.col("r.block") == 1)
    return judged.select(
        F.col("id").alias(id_col), "host", "path", F.col("r.rule").alias("rule"),
        F.when(blocked, "block").otherwise("allow").alias("verdict"), "trust", "distrust")


#: The rules of the registered query.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def oracle(rules: list[tuple[str, str, str]] = RULES) -> str:
    """page_id, host, path, rule and verdict over ``pages`` as DuckDB SQL, rounds unrolled."""
    link = LINK.replace("'", "''")
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    parts = [f"""
WITH u AS (SELECT page_id, html, strpos(url, '://') AS i, substr(url, strpos(url, '://') + 3) AS rest FROM pages),
n AS (SELECT page_id, html, CASE WHEN i > 0 THEN translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') ELSE '' END AS host,
             CASE WHEN i > 0 THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM u),
r AS (SELECT * FROM (VALUES {values}) v(verdict, rule_host, rule_path)),
h AS (SELECT DISTINCT n.host, n.path, r.* FROM (SELECT DISTINCT host, path FROM n) n
      JOIN r ON (n.host = rule_host OR ends_with(n.host, '.' || rule_host)) AND starts_with(n.path, rule_path)),
w AS (SELECT host, path, rule_host || rule_path AS rule, verdict FROM h
      QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(rule_host || rule_path) DESC, verdict DESC, rule_host || rule_path DESC) = 1),
j AS MATERIALIZED (SELECT n.page_id, n.host, n.path, w.rule, w.verdict FROM n LEFT JOIN w ON n.host = w.host AND n.path = w.path),
l AS (SELECT host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)), '{UPPER}', '{LOWER}') AS dst FROM n),
e AS MATERIALIZED (SELECT src, dst, count(*) AS n FROM l WHERE src <> '' AND src <> dst GROUP BY 1, 2),
f AS MATERIALIZED (SELECT src AS a, dst AS b, n / sum(n) OVER (PARTITION BY src) AS w FROM e),
g AS MATERIALIZED (SELECT dst AS a, src AS b, n / sum(n) OVER (PARTITION BY dst) AS w FROM e)"""]
    for name, steps, verdict in (("t", "f", "allow"), ("d", "g", "block")):
        parts.append(f"""
{name}0 AS MATERIALIZED (SELECT host, {1 - DAMPING!r} * count(*) / sum(count(*)) OVER () AS x FROM j WHERE verdict = '{verdict}' GROUP BY 1)""")
        for i in range(1, ROUNDS + 1):
            parts.append(f"""
{name}{i} AS MATERIALIZED (SELECT b AS host, {DAMPING!r} * sum(x * w) AS x FROM {name}{i - 1} JOIN {steps} ON a = host GROUP BY 1)""")
        union = " UNION ALL ".join(f"SELECT * FROM {name}{i}" for i in range(1, ROUNDS + 1))
        parts.append(f"""
{name} AS (SELECT host, sum(x) AS x FROM ({union}) GROUP BY 1)""")
    return ",".join(parts) + f"""
SELECT j.page_id, j.host, j.path, j.rule,
       coalesce(j.verdict, CASE WHEN coalesce(d.x, 0) > {THRESHOLD} * (coalesce(t.x, 0) + coalesce(d.x, 0)) THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN t ON t.host = j.host LEFT JOIN d ON d.host = j.host"""
