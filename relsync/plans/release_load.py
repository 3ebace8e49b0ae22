"""Load one dataset, or a whole release, into catalog tables.

Per dataset: skip when this release was already loaded; list files; verify them
against the manifest; read them (footer check); project; check the key; replace or
merge the table; check foreign keys; record the attempt in the ledger. The data is read for
the checksums, for the key check (key columns only) and for the write, which is one plan from
scan to merged rows: a shuffle for the carry-over join, none when no column was removed, one for
both where the merge is counted. Foreign keys are checked on the written generation.

Datasets whose foreign keys form a circle (a dataset that refers to itself included) are one
group: all are staged, checked against each other's staged rows and published as one commit. If
any of them fails, none is published.
"""

from __future__ import annotations

import datetime as dt
import logging
import threading
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relsync.operators.checks import KeyViolation, Reference, check_keys, orphan_keys
from relsync.operators.evolve import SchemaDiff, diff_schemas
from relsync.operators.integrity import hash_changed, hash_files, require_verified, settled, verify_files
from relsync.operators.merge import merge_counts, merge_snapshot, replace_snapshot
from relsync.operators.projection import project
from relsync.plans.ledger import latest_per_dataset, ledger_row
from relsync.plans.resume import BATCH_FILES, forget, resumable_rows
from relsync.plans.sink import Sink, Staged
from relsync.plans.validate import check_readers, check_results, require_checks
from relsync.sources.inventory import file_inventory, latest_version
from relsync.sources.manifest import load_manifest
from relsync.sources.parquet import NoFiles, read_dataset
from relsync.spec import DatasetSpec, Source

log = logging.getLogger(__name__)

LOAD_TYPES = ("delta", "full")

OUTCOME_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType(), False),
        T.StructField("table", T.StringType(), False),
        T.StructField("version", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("rows_loaded", T.LongType(), True),
        T.StructField("message", T.StringType(), True),
        T.StructField("columns_added", T.ArrayType(T.StringType()), True),
        T.StructField("columns_retyped", T.ArrayType(T.StringType()), True),
        T.StructField("columns_removed", T.ArrayType(T.StringType()), True),
        T.StructField("inserted", T.LongType(), True),
        T.StructField("updated", T.LongType(), True),
        T.StructField("deleted", T.LongType(), True),
        T.StructField("unchanged", T.LongType(), True),
    ]
)


@dataclass
class Outcome:
    dataset: str
    table: str
    version: str
    status: str  # loaded / skipped_already_loaded / skipped_no_files / failed
    rows_loaded: int | None = None
    message: str | None = None
    drift: SchemaDiff | None = None  # of a merge into an existing table
    counts: dict | None = None  # of a merge, where statistics were asked for

    def row(self) -> tuple:
        d, c = self.drift, self.counts or {}
        drift = (list(d.added), list(d.type_changed), list(d.removed)) if d else (None, None, None)
        return (self.dataset, self.table, self.version, self.status, self.rows_loaded, self.message,
                *drift, *(c.get(op) for op in ("insert", "update", "delete", "unchanged")))


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


_UNKNOWN = object()


def plan_load(raw: DataFrame, spec: DatasetSpec, current: DataFrame | None = None,
              load_type: str = "delta") -> DataFrame:
    """The rows a load of ``raw`` publishes: the dataset's projection rules, then the key check and
    (delta) the snapshot merge into ``current``, as a sink applies them."""
    staged = project(raw, spec)
    keys = list(spec.output_key())
    return replace_snapshot(staged, keys) if load_type == "full" else merge_snapshot(staged, current, keys)


def check_foreign_keys(rows: DataFrame, spec: DatasetSpec, parents: Callable[[str], DataFrame | None],
                       only: set[str] | None = None) -> None:
    """Raise when a row refers to a row that the referenced table does not have; one job for all of the
    dataset's foreign keys. ``parents`` gives a table's rows, None where there is no table; ``only``
    limits the check to keys into these tables."""
    references = {}
    for fk in spec.foreign_keys:
        if only is not None and fk.table not in only:
            continue
        parent = parents(fk.table)
        if parent is None:
            raise KeyViolation(f"foreign key {fk.columns} of {spec.name}: no table {fk.table!r}")
        references[f"{spec.name} refers to {fk.table} by {', '.join(fk.columns)}"] = Reference(fk.columns, parent, fk.references)
    check_keys(rows, {}, references)


def reference_report(frames: Mapping[str, DataFrame], specs: Sequence[DatasetSpec]) -> DataFrame | None:
    """``(table, foreign_key, parent, key, n)``: every foreign-key value without a parent row, over
    all references between the given tables' rows (a circle's staged rows, say). ``key`` is the JSON
    text of the values. References to tables that are not given are left out; None if none is left."""
    out = None
    for spec in specs:
        for fk in spec.foreign_keys:
            if spec.table_name not in frames or fk.table not in frames:
                continue
            orphans = orphan_keys(frames[spec.table_name], frames[fk.table], fk.columns, fk.references)
            values = [f"__{i}" for i in range(len(fk.columns))]
            part = orphans.toDF(*values, "n").select(
                F.lit(spec.table_name).alias("table"), F.lit(",".join(fk.columns)).alias("foreign_key"), F.lit(fk.table).alias("parent"),
                F.to_json(F.array(*[F.col(c).cast("string") for c in values])).alias("key"), "n")
            out = part if out is None else out.unionByName(part)
    return out


@dataclass
class Prepared:
    """A dataset's new generation, written and verified, not yet published."""

    spec: DatasetSpec
    version: str
    start: dt.datetime
    staged: Staged
    rows: DataFrame  # the staged generation; the projected source where the sink does not write ahead
    current: DataFrame | None  # the table that it is merged into
    drift: SchemaDiff | None
    work: str | None = None  # a resumable load's folder


def _failed(sink: Sink, spec: DatasetSpec, version: str, start: dt.datetime, error: Exception) -> None:
    try:
        sink.record(ledger_row(version, spec.name, False, 0, start, _now(), str(error)))
    except Exception as ledger_error:  # never hide the load's own error behind this one
        log.error("could not record the failure of %s: %s", spec.name, ledger_error)


def prepare_dataset(spark: SparkSession, spec: DatasetSpec, source: Source, version: str,
                    sink: Sink, load_type: str = "delta", force: bool = False,
                    manifest: DataFrame | None = None, schema_mode: str = "strict",
                    last_loaded=_UNKNOWN, overlap_verify: bool = True, statistics: bool = False,
                    remember: bool = False, resume: str | None = None, batch_files: int = BATCH_FILES) -> Outcome | Prepared:
    """Everything of a load up to publishing: an outcome where there is nothing to load. Raises on
    failure after recording it in the ledger."""
    if load_type not in LOAD_TYPES:
        raise ValueError(f"load_type must be one of {LOAD_TYPES}")
    table = spec.table_name
    if last_loaded is _UNKNOWN and not force:
        last_loaded = sink.last_success(spec.name)
    if not force and last_loaded == version:
        return Outcome(spec.name, table, version, "skipped_already_loaded",
                       message=f"release {version} already loaded")
    start = _now()
    pattern = f"{source.dataset_dir(version, spec.name)}/*.parquet"
    # Verification reads every byte, and so does the load: with ``overlap_verify`` both run
    # at once (their jobs share the cluster) and the new generation is published only
    # after verification passed; a failed verification discards it.
    pool = ThreadPoolExecutor(max_workers=1) if manifest is not None and overlap_verify else None
    try:
        sink.check_target(table)
        inventory = file_inventory(spark, pattern, through=source.through)  # listed once, for both

        def verify() -> None:
            memory = sink.hashes() if remember else None
            if memory is None:
                hashed, fresh = hash_files(spark, pattern, filesystem=source.filesystem, inventory=inventory), None
            else:
                hashed, fresh = hash_changed(spark, pattern, memory, source.filesystem, inventory)
            try:
                require_verified(verify_files(hashed, manifest, source.relative_prefix(spec.name), suffix=".parquet"))
                if fresh is not None and settled(fresh).take(1):
                    sink.remember_hashes(settled(fresh))
            finally:
                if fresh is not None:
                    fresh.unpersist()

        checked = pool.submit(verify) if pool else None
        if manifest is not None and pool is None:
            verify()

        def verified() -> None:
            if checked is not None:
                checked.result()

        try:
            raw = read_dataset(spark, pattern, mode=schema_mode, filesystem=source.filesystem, inventory=inventory, through=source.through)
            staged_df = project(raw, spec)
            work = f"{resume.rstrip('/')}/{spec.name}/{version}" if resume else None
            if work:
                staged_df = _by_batches(spark, work, inventory, raw, staged_df, spec, source, schema_mode, batch_files)
            keys = list(spec.output_key())
            have = {c.lower() for c in staged_df.columns}
            missing = [k for k in keys if k.lower() not in have]
            if missing:
                raise ValueError(f"key column(s) {missing} not in the projected data of {spec.name}")
            current = sink.read(table) if load_type == "delta" and sink.exists(table) else None
            drift = diff_schemas(staged_df.schema, current.schema) if current is not None else None
            staged = sink.stage(table, staged_df, keys, load_type, **({"statistics": True} if statistics else {}))
        except NoFiles:
            verified()
            return Outcome(spec.name, table, version, "skipped_no_files",
                           message=f"no Parquet files for {spec.name}")
        except Exception:
            verified()  # an integrity failure is reported before any other
            raise
        try:
            verified()
        except Exception:
            staged.discard()
            raise
        return Prepared(spec, version, start, staged, staged.data if staged.data is not None else staged_df, current, drift, work)
    except Exception as e:
        _failed(sink, spec, version, start, e)
        raise
    finally:
        if pool is not None:
            pool.shutdown(wait=True)


def _by_batches(spark: SparkSession, work: str, inventory: DataFrame, raw: DataFrame, projected: DataFrame, spec: DatasetSpec,
                source: Source, schema_mode: str, batch_files: int) -> DataFrame:
    """The projected rows by way of a resumable load's work folder."""
    if source.through is not None:
        raise ValueError("a remote source cannot be loaded resumably")

    def read(paths: Sequence[str]) -> DataFrame:
        if not paths:
            return projected.limit(0)
        if schema_mode == "merge":  # each batch may lack columns, or have narrower ones
            some = read_dataset(spark, list(paths), mode="merge")
            have = {c.lower() for c in some.columns}
            some = some.select(*[(F.col(f"`{f.name}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in raw.schema])
        else:
            some = spark.read.schema(raw.schema).parquet(*paths)
        return project(some, spec)

    return resumable_rows(spark, work, inventory, read, batch_files)


def publish_group(group: Sequence[Prepared], sink: Sink, statistics: bool = False,
                  beside: Sequence[DatasetSpec] = ()) -> list[Outcome]:
    """Check the foreign keys of staged datasets against each other's staged rows (and other tables'
    published ones), then publish all as one commit. On any failure none is published, each
    failure is recorded, and the error raised. ``beside`` are datasets whose published tables stay
    as they are and must still find their rows in the staged ones."""
    ahead = {p.spec.table_name: p.rows for p in group}

    def rows_of(table: str) -> DataFrame | None:
        if table in ahead:
            return ahead[table]
        return sink.read(table) if sink.exists(table) else None

    try:
        for p in group:
            check_foreign_keys(p.rows, p.spec, rows_of)
        for spec in beside:
            if sink.exists(spec.table_name):
                check_foreign_keys(sink.read(spec.table_name), spec, rows_of, only=set(ahead))
        counts = {}
        if statistics:
            for p in group:
                if p.current is not None:
                    counts[p.spec.name] = p.staged.counts or merge_counts(p.rows, p.current, list(p.spec.output_key()))
        for p in group:
            p.staged.release = p.version
        sink.publish_together([p.staged for p in group])
    except Exception as e:
        for p in group:
            p.staged.discard()  # whatever failed, nothing unpublished stays behind
            _failed(sink, p.spec, p.version, p.start, e)
        raise
    for p in group:
        sink.record(ledger_row(p.version, p.spec.name, True, p.staged.rows, p.start, _now()))
        if p.work:
            forget(p.work)
    return [Outcome(p.spec.name, p.spec.table_name, p.version, "loaded", p.staged.rows, drift=p.drift, counts=counts.get(p.spec.name))
            for p in group]


def load_dataset(spark: SparkSession, spec: DatasetSpec, source: Source, version: str,
                 sink: Sink, load_type: str = "delta", force: bool = False,
                 manifest: DataFrame | None = None, schema_mode: str = "strict",
                 last_loaded=_UNKNOWN, overlap_verify: bool = True, statistics: bool = False,
                 remember: bool = False, resume: str | None = None, batch_files: int = BATCH_FILES) -> Outcome:
    """Load one dataset of a release. Raises on failure after recording it in the ledger.

    ``last_loaded`` is the dataset's latest successful release when the caller already
    knows it (``load_release`` reads the ledger once for all datasets). ``statistics`` counts
    inserted, updated, deleted and unchanged keys of a merge, in the merge's own plan where the
    sink can, else by one more join. References to itself are checked on the new rows. ``remember``
    keeps file hashes in the sink, and reads only files for checksums that it does not know as they are.
    ``resume`` names a shared folder that keeps what a killed load has read, in batches of
    ``batch_files`` files, for the next one (see ``plans.resume``).
    """
    done = prepare_dataset(spark, spec, source, version, sink, load_type, force, manifest, schema_mode,
                           last_loaded, overlap_verify, statistics, remember, resume, batch_files)
    return done if isinstance(done, Outcome) else publish_group([done], sink, statistics)[0]


def load_groups(specs: Sequence[DatasetSpec]) -> list[list[list[DatasetSpec]]]:
    """Datasets in waves of groups. A group is a circle of foreign keys (the datasets that refer to
    each other, directly or through others), mostly one dataset; each wave comes after those
    whose tables its groups refer to."""
    refers = [{j for j, t in enumerate(specs) if t.table_name in {k.table for k in s.foreign_keys}} for s in specs]

    def reached(start: int) -> set[int]:
        seen: set[int] = set()
        left = [start]
        while left:
            new = refers[left.pop()] - seen
            seen |= new
            left += new
        return seen

    reach = [reached(i) for i in range(len(specs))]
    circles = [tuple(sorted({i} | {j for j in reach[i] if i in reach[j]})) for i in range(len(specs))]
    left, waves = list(dict.fromkeys(circles)), []
    done: set[int] = set()
    while left:
        ready = [g for g in left if all(refers[i] <= done | set(g) for i in g)]
        waves.append([[specs[i] for i in g] for g in ready])
        done |= {i for g in ready for i in g}
        left = [g for g in left if g not in ready]
    return waves


def load_order(specs: Sequence[DatasetSpec]) -> list[list[DatasetSpec]]:
    """Datasets in waves: each after those whose tables its foreign keys refer to. Datasets that
    refer to each other in a circle share a wave."""
    return [[s for group in wave for s in group] for wave in load_groups(specs)]


def load_group(group: Sequence[DatasetSpec], prepare: Callable[[DatasetSpec], Outcome | Prepared], sink: Sink,
               statistics: bool = False) -> tuple[list[Outcome], dict[str, Exception]]:
    """Load datasets that refer to each other: all are prepared (at once), then published as one.
    Returns the outcomes, and the errors by dataset; with any error none is published."""
    outcomes, ready, errors = [], [], {}
    with ThreadPoolExecutor(max_workers=len(group)) as pool:
        for spec, fut in [(s, pool.submit(prepare, s)) for s in group]:
            try:
                done = fut.result()
                (ready if isinstance(done, Prepared) else outcomes).append(done)
            except Exception as e:
                errors[spec.name] = e
    if errors:
        why = RuntimeError(f"not published, since {', '.join(sorted(errors))} failed: a circle of foreign keys is published as one")
        for p in ready:
            p.staged.discard()
            _failed(sink, p.spec, p.version, p.start, why)
            errors[p.spec.name] = why
        return outcomes, errors
    if ready:
        staying = {o.dataset for o in outcomes}
        try:
            outcomes += publish_group(ready, sink, statistics, beside=[s for s in group if s.name in staying])
        except Exception as e:
            errors.update({p.spec.name: e for p in ready})
    return outcomes, errors


def load_release(spark: SparkSession, specs: Sequence[DatasetSpec], source: Source,
                 sink: Sink, version: str | None = None,
                 datasets: Sequence[str] | None = None, load_type: str = "delta",
                 force: bool = False, continue_on_error: bool = True, verify: bool = True,
                 schema_mode: str = "strict", max_workers: int = 4, statistics: bool = False,
                 remember: bool = False, resume: str | None = None, batch_files: int = BATCH_FILES) -> DataFrame:
    """Load a release (default: the newest). One outcome row per dataset.

    Pre-flight checks and the manifest check run first; a failure there loads nothing.
    Datasets load concurrently from ``max_workers`` driver threads (their Spark jobs share
    the cluster), those that others refer to by foreign keys first; circles of foreign keys are
    published as one commit, or not at all. With ``continue_on_error`` a failed dataset is reported and the others still load; without it the first failure is
    raised once running loads finish and no further dataset starts.
    """
    newest = None
    if version is None:
        try:
            newest = latest_version(spark, source)
        except Exception:  # reported by the source check below
            newest = None
    readers = {"readers": lambda: check_readers(source, newest or version)} if verify or schema_mode != "first" else {}
    require_checks(check_results(spark, source, specs, readers, sink=sink, newest=newest))
    version = version or newest or latest_version(spark, source)
    if datasets is not None:
        unknown = sorted(set(datasets) - {s.name for s in specs})
        if unknown:
            raise ValueError(f"datasets without a definition: {', '.join(unknown)}")
    chosen = [s for s in specs if datasets is None or s.name in set(datasets)]
    manifest = load_manifest(spark, source, version).cache() if verify else None
    # one small job for every dataset's latest success (one row per dataset)
    latest = {r["dataset_name"]: r["version"]
              for r in latest_per_dataset(sink.ledger()).select("dataset_name", "version")
              .where(F.col("dataset_name").isin([s.name for s in chosen])).collect()}
    outcomes: dict[str, Outcome] = {}
    stop = threading.Event()
    running = threading.BoundedSemaphore(max(1, max_workers))

    def prepare(spec: DatasetSpec) -> Outcome | Prepared:
        with running:
            return prepare_dataset(spark, spec, source, version, sink, load_type, force,
                                   manifest, schema_mode, latest.get(spec.name), statistics=statistics, remember=remember,
                                   resume=resume, batch_files=batch_files)

    def run(group: list[DatasetSpec]) -> list[Outcome]:
        if stop.is_set():
            return []
        done, errors = load_group(group, prepare, sink, statistics)
        for spec in group:
            e = errors.get(spec.name)
            if e is None:
                continue
            log.error("dataset %s failed: %s", spec.name, e)
            if not continue_on_error:
                stop.set()
                raise e
            done.append(Outcome(spec.name, spec.table_name, version, "failed", 0,
                                " ".join(str(e).split("\n"))))
        return done

    try:
        first_error = None
        for wave in load_groups(chosen):
            with ThreadPoolExecutor(max_workers=max(1, max_workers)) as pool:
                for fut in as_completed([pool.submit(run, group) for group in wave]):
                    try:
                        done = fut.result()
                    except Exception as e:  # only when continue_on_error is False
                        first_error = first_error or e
                        continue
                    outcomes.update({out.dataset: out for out in done})
        if first_error is not None:
            raise first_error
    finally:
        if manifest is not None:
            manifest.unpersist()
    ordered = [outcomes[s.name] for s in chosen if s.name in outcomes]
    return spark.createDataFrame([o.row() for o in ordered], OUTCOME_SCHEMA)
