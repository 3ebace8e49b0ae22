"""Catalog sink: tables published as generations behind a view, and the load ledger.

Built-in file tables cannot be merged into, replaced while being read, or swapped in
place. So every load writes a new generation table ``<table>__g<id>`` and then points
the view ``<table>`` at it; the view switch is the commit point. A failed load leaves
the view, and so every reader, on the previous generation. The view names the published
generations that are kept (for rollback) in a property; older ones, and any a crashed load left
unpublished, are dropped. A plain table of that name becomes the first generation.

Several tables that refer to each other are published as one commit: what all their views will
name is written to a property of the database, one catalog call that decides the commit, then
the views are switched and the property is cleared. A process that dies in between leaves the
property, and the next load (or ``recover``) completes the switch before anything else; an error
while switching puts the switched views back. Between two view switches a reader of both tables
can meet the new one beside the old one, as the catalog has no call that replaces two views.

The view's property names each kept generation with the release it holds, in the same call that
switches the view, so a table can be read as of a release (``read_as_of``), and kept by release.

A catalog with row-level operations could use ``DataFrame.mergeInto`` instead; the
public methods stay the same.
"""

from __future__ import annotations

import base64
import json
import logging
import re
import threading
import time
import uuid
from abc import ABC, abstractmethod
from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from relsync.operators.evolve import diff_schemas
from relsync.operators.integrity import MEMORY_SCHEMA
from relsync.operators.merge import OPS, change_rows, merge_counted, merge_counts, merge_snapshot, replace_snapshot
from relsync.functions.versions import version_key
from relsync.plans import ledger as L
from relsync.streaming.change_feed import ChangeFeed

log = logging.getLogger(__name__)

GEN_MARK = "__g"
#: View property: published generations, the current one first, each as ``name`` or ``name@release``.
GEN_PROPERTY = "relsync.generations"
#: Database property: a commit of several tables that was decided and may not be finished.
COMMIT_PROPERTY = "relsync.commit"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _generation(entry: str) -> str:
    return entry.split("@", 1)[0]


@dataclass
class Staged:
    """A snapshot written but not yet visible; ``publish`` makes it the table.

    generation  the sink's name of it, where it is written ahead of publishing
    data        its rows as readers will see them; None where nothing is written yet
    counts      rows inserted, updated, deleted and unchanged by a merge, when asked for
    release     the release that the rows come from, where the loader names it before publishing
    """

    table: str
    rows: int | None
    publish: Callable[[], int]
    discard: Callable[[], None] = lambda: None
    generation: str | None = None
    data: DataFrame | None = None
    counts: dict | None = None
    release: str | None = None


class Sink(ABC):
    """What a load needs from a target; implement it for another kind of target.

    ``replace`` and ``merge`` publish a whole snapshot atomically and return the number of
    rows written; ``record`` appends one ledger row (see ``plans.ledger.LEDGER_SCHEMA``).
    ``stage`` splits that into write-then-publish; the default defers the whole write to
    ``publish``, a sink that can write invisibly overrides it.
    """

    def stage(self, table: str, df: DataFrame, keys: Sequence[str], load_type: str, statistics: bool = False) -> Staged:
        write = self.replace if load_type == "full" else self.merge
        return Staged(table, None, lambda: write(table, df, keys))

    def publish_together(self, staged: Sequence[Staged]) -> None:
        """Publish several staged tables, all or none; a sink that can commit them as one overrides
        this. One table is published by itself."""
        if len(staged) > 1:
            raise NotImplementedError("this sink cannot publish tables that refer to each other")
        for s in staged:
            s.rows = s.publish()

    @abstractmethod
    def ensure_database(self) -> None: ...

    @abstractmethod
    def exists(self, table: str) -> bool: ...

    @abstractmethod
    def read(self, table: str) -> DataFrame: ...

    @abstractmethod
    def replace(self, table: str, df: DataFrame, keys: Sequence[str]) -> int: ...

    @abstractmethod
    def merge(self, table: str, df: DataFrame, keys: Sequence[str]) -> int: ...

    def check_target(self, table: str) -> None:
        """Raise when ``table`` cannot be published to; called before any work."""

    @abstractmethod
    def ledger(self) -> DataFrame: ...

    @abstractmethod
    def record(self, row: tuple) -> None: ...

    def hashes(self) -> DataFrame | None:
        """Remembered file hashes (``integrity.MEMORY_SCHEMA``); None: this sink remembers none."""
        return None

    def remember_hashes(self, rows: DataFrame) -> None:
        """Add to the remembered hashes."""

    def last_success(self, dataset: str) -> str | None:
        return L.last_success_version(self.ledger(), dataset)


class CatalogSink(Sink):
    """Tables of one catalog database, published as generations behind views.

    fmt               file format of the generation tables (``parquet`` by default)
    ledger_table      name of the ledger table in the same database
    keep_generations  published generations kept: 2 keeps the previous one for rollback, 1 only
                      the current one
    bucket_by_key     write generations bucketed (and sorted) by key into this many buckets
    keep_releases     keep the newest generation of so many newest releases instead, for ``read_as_of``
    feed              a ``ChangeFeed`` that gets the rows every published generation changed
    """

    def __init__(self, spark: SparkSession, database: str = "default", fmt: str = "parquet",
                 ledger_table: str = "relsync_load_ledger", keep_generations: int = 2,
                 bucket_by_key: int | None = None, feed: ChangeFeed | None = None, keep_releases: int | None = None):
        self.spark = spark
        self.database = database
        self.fmt = fmt
        self.ledger_table = ledger_table
        if keep_generations < 1:
            raise ValueError("keep_generations must be 1 or more")
        self.keep = keep_generations
        self.bucket_by_key = bucket_by_key
        self.feed = feed
        if keep_releases is not None and keep_releases < 1:
            raise ValueError("keep_releases must be 1 or more")
        self.keep_releases = keep_releases
        # appends to one table directory must not overlap (their commits share a
        # temporary folder), so ledger writes and catalog DDL are serialised
        self._lock = threading.RLock()

    # --- catalog -------------------------------------------------------------------------
    def fq(self, table: str) -> str:
        return f"{_q(self.database)}.{_q(table)}"

    def ensure_database(self) -> None:
        with self._lock:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(self.database)}")
            self.recover()

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{table}")

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.fq(table))

    def columns(self, table: str) -> list[str]:
        return self.read(table).columns

    def dtypes(self, table: str) -> dict:
        return dict(self.read(table).dtypes)

    def _tables_like(self, prefix: str) -> list[str]:
        """Names that start with ``prefix``, sorted: one listing, limited by the catalog."""
        found = self.spark.sql(f"SHOW TABLES IN {_q(self.database)} LIKE '{prefix.lower()}*'").collect()
        return sorted(r["tableName"] for r in found if r["tableName"].lower().startswith(prefix.lower()))

    def generations(self, table: str) -> list[str]:
        return self._tables_like(table + GEN_MARK)

    def published(self, table: str) -> list[str] | None:
        """Published generations, the current one first; None when ``table`` is no view of ours."""
        return [_generation(e) for e in self._entries(table)] or None

    def _entries(self, table: str) -> list[str]:
        """What the view's property says: published generations with their releases."""
        if not self.exists(table) or not self._is_view(table):
            return []
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.fq(table)}").collect()
        kept = next((r["value"] for r in rows if r["key"] == GEN_PROPERTY), "")
        return [e for e in kept.split(",") if e]

    def releases(self, table: str) -> list[tuple[str, str | None]]:
        """(generation, release) of every published generation that is kept, the current one first."""
        return [(_generation(e), e.split("@", 1)[1] if "@" in e else None) for e in self._entries(table)]

    def as_of(self, table: str, version: str) -> tuple[str, str]:
        """(generation, release) that shows the table as of a release: the newest release that is not
        newer, and of it what was published last. Raises when no such generation is kept."""
        known = [(g, r) for g, r in self.releases(table) if r is not None and version_key(r) <= version_key(version)]
        if not known:
            raise LookupError(f"no generation of {self.fq(table)} as of release {version} is kept")
        newest = max(version_key(r) for _, r in known)
        return next((g, r) for g, r in known if version_key(r) == newest)

    def read_as_of(self, table: str, version: str) -> DataFrame:
        """The rows the table had as of a release (see ``as_of``)."""
        return self._generation_rows(self.as_of(table, version)[0])

    def _retained(self, entries: list[str]) -> list[str]:
        """The entries to keep of all published ones, the current one first."""
        if self.keep_releases is None:
            return entries[: self.keep]
        of = [(e.split("@", 1)[1] if "@" in e else None) for e in entries]
        newest = sorted({r for r in of if r is not None}, key=version_key, reverse=True)[: self.keep_releases]
        return [e for i, (e, r) in enumerate(zip(entries, of)) if i == 0 or (r in newest and r not in of[:i])]

    def _is_view(self, table: str) -> bool:
        return self.spark.catalog.getTable(f"{self.database}.{table}").tableType == "VIEW"

    def check_target(self, table: str) -> None:
        """Raise when ``table`` is a view that this sink has not made."""
        if self.exists(table) and self._is_view(table) and self.current_generation(table) is None:
            raise ValueError(f"{self.fq(table)} is a view of something else; it cannot be loaded into")

    # --- publishing ------------------------------------------------------------------------
    def _new_name(self, table: str) -> str:
        """A generation's name; names sort by the time they were made."""
        return f"{table}{GEN_MARK}{int(time.time() * 1000):015d}_{uuid.uuid4().hex[:8]}"

    def _write_generation(self, table: str, df: DataFrame, keys: Sequence[str]) -> tuple[str, int]:
        gen = self._new_name(table)
        obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
        bucketed = bool(self.bucket_by_key and keys)
        if bucketed:
            # one file per bucket (not one per task and bucket); later merges and key joins
            # read the table already partitioned by key and skip its shuffle
            df = df.repartition(self.bucket_by_key, *[F.col(f"`{k}`") for k in keys])
        counted = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        writer = counted.write.format(self.fmt).mode("errorifexists")
        if bucketed:
            writer = writer.bucketBy(self.bucket_by_key, *keys).sortBy(*keys)
        writer.saveAsTable(self.fq(gen))
        return gen, int(obs.get.get("rows", 0))

    def current_generation(self, table: str) -> str | None:
        """The generation the table's view reads now (None when there is no such view)."""
        published = self.published(table)
        if published:
            return published[0]
        if not self.exists(table) or not self._is_view(table):
            return None
        # a view from before generations were named in a property
        info = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.fq(table)}").collect()
        text = next((r["data_type"] for r in info if r["col_name"] == "View Text"), "") or ""
        names = [g for g in self.generations(table) if g.lower() in text.lower()]
        return max(names, key=len) if names else None

    def _adopt(self, table: str) -> list[str]:
        """The entries of ``table``'s published generations, the current one first; a plain table of
        that name becomes one. Empty where there is no table."""
        published = self._entries(table)
        if published or not self.exists(table):
            return published
        current = self.current_generation(table)
        if current is None:
            self.check_target(table)
            # a plain table: it becomes the generation before this one
            current = f"{table}{GEN_MARK}{0:015d}_{uuid.uuid4().hex[:8]}"
            self.spark.sql(f"ALTER TABLE {self.fq(table)} RENAME TO {self.fq(current)}")
            try:
                self._point(table, [current])
            except Exception:
                self.spark.sql(f"ALTER TABLE {self.fq(current)} RENAME TO {self.fq(table)}")
                raise
        return [current]

    def _drop_superseded(self, table: str, kept: list[str]) -> None:
        """Names sort by write time: what is older than the current generation and not kept is
        superseded, or was left by a crashed load. Newer ones may belong to a load still running."""
        for old in self.generations(table):
            if old not in kept and old < kept[0]:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.fq(old)}")

    def _body(self, generation: str) -> str:
        """The query that reads a generation."""
        return f"SELECT * FROM {self.fq(generation)}"

    def _point(self, table: str, kept: list[str]) -> None:
        """The commit of one table: readers see the first of ``kept`` (entries) from here on."""
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.fq(table)} TBLPROPERTIES ('{GEN_PROPERTY}' = '{','.join(kept)}') "
                       f"AS {self._body(_generation(kept[0]))}")

    def _decide(self, target: dict[str, list[str]]) -> None:
        """Record (or, empty, clear) what the views of several tables are to name: one catalog call."""
        value = base64.urlsafe_b64encode(json.dumps(target).encode()).decode() if target else ""
        self.spark.sql(f"ALTER DATABASE {_q(self.database)} SET DBPROPERTIES ('{COMMIT_PROPERTY}' = '{value}')")

    def decided(self) -> dict[str, list[str]]:
        """The commit of several tables that was decided and not finished: generations by table."""
        if not self.spark.catalog.databaseExists(self.database):
            return {}
        rows = self.spark.sql(f"DESCRIBE DATABASE EXTENDED {_q(self.database)}").collect()
        text = next((r["info_value"] for r in rows if r["info_name"] == "Properties"), "") or ""
        found = re.search(re.escape(COMMIT_PROPERTY) + r",([A-Za-z0-9_=-]+)", text)
        return json.loads(base64.urlsafe_b64decode(found[1])) if found else {}

    def recover(self) -> list[str]:
        """Complete a commit that a process decided but did not live to finish; the tables switched."""
        with self._lock:
            target = self.decided()
            if not target:
                return []
            if all(self.exists(_generation(e)) for kept in target.values() for e in kept[:1]):
                for table, kept in target.items():
                    self._point(table, kept)
                    self._tell(table)
            self._decide({})
            return sorted(target)

    def _tell(self, table: str) -> None:
        """List the published generation in the change feed, if it is not listed yet."""
        published = self.published(table) if self.feed is not None else None
        if published:
            self.feed.publish(table, published[0])

    def publish_together(self, staged: Sequence[Staged]) -> None:
        """Make every one of ``staged`` the table, or none: see the module's text."""
        with self._lock:
            self.recover()
            before = {s.table: self._adopt(s.table) for s in staged}
            for s in staged:
                self._tell(s.table)  # a process may have ended between its switch and its listing
            target = {}
            for s in staged:
                entry = s.generation if s.release is None else f"{s.generation}@{s.release}"
                target[s.table] = self._retained([entry, *(e for e in before[s.table] if _generation(e) != s.generation)])
            if len(target) > 1:
                self._decide(target)
            switched: list[str] = []
            try:
                for table, kept in target.items():
                    self._point(table, kept)
                    switched.append(table)
            except Exception:
                self._undo({t: before[t] for t in switched})
                raise
            finally:
                if len(target) > 1:
                    self._decide({})
            for table, kept in target.items():
                self._tell(table)
                self._drop_superseded(table, [_generation(e) for e in kept])

    def _undo(self, before: dict[str, list[str]]) -> None:
        """Point views back at what they named, or drop those that were not there."""
        for table, published in before.items():
            try:
                if published:
                    self._point(table, published)
                else:
                    self.spark.sql(f"DROP VIEW IF EXISTS {self.fq(table)}")
            except Exception as e:  # its new generation is then kept, see discard
                log.error("could not put the view %s back: %s", table, e)

    def stage(self, table: str, df: DataFrame, keys: Sequence[str], load_type: str, statistics: bool = False) -> Staged:
        """Check the key and write the new generation; readers still see the old one. With
        ``statistics`` a merge into an existing table counts what it does to rows, in the same plan."""
        self.ensure_database()
        self.check_target(table)
        current = self.read(table) if load_type != "full" and self.exists(table) else None
        observed = None
        if load_type == "full":
            df = replace_snapshot(df, keys) if keys else df
        elif statistics and current is not None and keys:
            df, observed = merge_counted(df, current, keys)
        else:
            df = merge_snapshot(df, current, keys, check_keys=bool(keys))
        if self.feed is not None and not keys:
            raise ValueError(f"{table} has no key; a change feed needs one")
        gen, rows = self._write_generation(table, df, keys)
        if self.feed is not None:
            new, old = self._changed_rows(table, gen)
            self.feed.write(table, gen, change_rows(new, old, keys))

        def publish() -> int:
            self.publish_together([staged])
            return rows

        def discard() -> None:
            # a view that could not be put back still reads it
            if gen not in (self.published(table) or []):
                self._drop_generation(table, gen)

        staged = Staged(table, rows, publish, discard, gen, self._generation_rows(gen))
        if observed is not None:
            counts = {op: int(observed.get.get(op) or 0) for op in OPS}
            if sum(counts[op] for op in OPS if op != "delete") != rows:
                # tasks that ran again were counted again
                counts = merge_counts(staged.data, current, keys, check_keys=False)
            staged.counts = counts
        return staged

    def _changed_rows(self, table: str, gen: str) -> tuple[DataFrame, DataFrame | None]:
        """Rows of a staged generation and of the current table (None without one) that hold all
        differences between the two."""
        return self._generation_rows(gen), self.read(table) if self.exists(table) else None

    def _generation_rows(self, gen: str) -> DataFrame:
        return self.spark.table(self.fq(gen))

    def _drop_generation(self, table: str, gen: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.fq(gen)}")
        if self.feed is not None:
            self.feed.discard(table, gen)

    def replace(self, table: str, df: DataFrame, keys: Sequence[str]) -> int:
        """Full refresh: check the key, write a new generation, switch. Returns rows written."""
        return self.stage(table, df, keys, "full").publish()

    def merge(self, table: str, df: DataFrame, keys: Sequence[str]) -> int:
        """Delta load: the table becomes the snapshot ``df`` (see ``merge_snapshot``)."""
        return self.stage(table, df, keys, "delta").publish()

    def drift(self, table: str, df: DataFrame):
        """Schema diff of a snapshot against the current table (None when absent)."""
        if not self.exists(table):
            return None
        return diff_schemas(df.schema, self.read(table).schema)

    # --- ledger ------------------------------------------------------------------------------
    def ledger(self) -> DataFrame:
        self._finish_compaction()
        if not self.exists(self.ledger_table):
            return L.ledger_frame(self.spark, [])
        return self.spark.table(self.fq(self.ledger_table))

    def hashes(self) -> DataFrame:
        name = f"{self.ledger_table}_hashes"
        if not self.exists(name):
            return self.spark.createDataFrame([], MEMORY_SCHEMA)
        return self.spark.table(self.fq(name))

    def remember_hashes(self, rows: DataFrame) -> None:
        with self._lock:
            self.ensure_database()
            rows.coalesce(1).write.format(self.fmt).mode("append").saveAsTable(self.fq(f"{self.ledger_table}_hashes"))

    def _finish_compaction(self) -> None:
        """Complete a compaction that ended between dropping the old ledger and renaming the new
        one: the new one was complete before the old one was dropped."""
        with self._lock:
            if self.spark.catalog.databaseExists(self.database) and not self.exists(self.ledger_table):
                done = self._tables_like(self.ledger_table + "__compact_")
                if done:
                    self.spark.sql(f"ALTER TABLE {self.fq(done[-1])} RENAME TO {self.fq(self.ledger_table)}")

    def compact_ledger(self, files: int = 1) -> int:
        """Rewrite the ledger (one small file per load attempt) into ``files`` files.

        The rows go to a new table first; the old one is dropped and the new one renamed
        only after that write succeeded. If the process ends between the two, the next reader
        or writer completes the rename. Leftovers of compactions that never got that far are
        dropped. No other process may append meanwhile. Returns the number of ledger rows.
        """
        with self._lock:
            self._finish_compaction()
            if not self.exists(self.ledger_table):
                return 0
            for left in self._tables_like(self.ledger_table + "__compact_"):
                self.spark.sql(f"DROP TABLE {self.fq(left)}")
            tmp = f"{self.ledger_table}__compact_{int(time.time() * 1000):015d}_{uuid.uuid4().hex[:8]}"
            obs = Observation(f"ledger_{uuid.uuid4().hex[:8]}")
            (self.ledger().observe(obs, F.count(F.lit(1)).alias("rows")).repartition(files)
             .write.format(self.fmt).saveAsTable(self.fq(tmp)))
            self.spark.sql(f"DROP TABLE {self.fq(self.ledger_table)}")
            self.spark.sql(f"ALTER TABLE {self.fq(tmp)} RENAME TO {self.fq(self.ledger_table)}")
            return int(obs.get.get("rows", 0))

    def record(self, row: tuple) -> None:
        with self._lock:
            self.ensure_database()
            self._finish_compaction()
            L.ledger_frame(self.spark, [row]).coalesce(1).write.format(self.fmt).mode(
                "append").saveAsTable(self.fq(self.ledger_table))
