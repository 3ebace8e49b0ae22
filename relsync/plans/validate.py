"""Pre-flight checks: run all, report all, stop before any work when one fails."""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from relsync.sources.files import NoReader, require_reader
from relsync.sources.inventory import list_versions
from relsync.spec import DatasetSpec, Source

CHECKS_SCHEMA = T.StructType(
    [
        T.StructField("check", T.StringType(), False),
        T.StructField("success", T.BooleanType(), False),
        T.StructField("message", T.StringType(), True),
    ]
)


def check_source(spark: SparkSession, source: Source,
                 newest: str | None = None) -> tuple[bool, str]:
    """At least one release is listed; the message names the newest (``newest``: already
    listed by the caller)."""
    if newest:
        return True, f"source reachable; newest release {newest}"
    try:
        rows = list_versions(spark, source).select("version").take(1)
    except Exception as e:  # listing errors are reported, not raised
        return False, f"could not list releases under {source.root}: {e}"
    if not rows:
        return False, f"no release found under {source.root}"
    return True, f"source reachable; newest release {rows[0]['version']}"


def check_readers(source: Source, version: str | None) -> tuple[bool, str]:
    """Footers and checksums of the data files can be read inside tasks."""
    uri = source.dataset_dir(version or "00.00", "any")
    try:
        require_reader(uri, source.filesystem)
    except NoReader as e:
        return False, str(e)
    return True, "data files can be opened inside tasks"


def check_specs(specs: Sequence[DatasetSpec]) -> tuple[bool, str]:
    """Every dataset spec names a non-empty primary key."""
    if not specs:
        return False, "no datasets are defined"
    missing = sorted(s.name for s in specs if not s.primary_key)
    if missing:
        return False, "datasets without a primary key: " + ", ".join(missing)
    return True, f"{len(specs)} dataset definitions have primary keys"


def check_target(sink) -> tuple[bool, str]:
    """The target can be written to (its database exists or can be created)."""
    try:
        sink.ensure_database()
    except Exception as e:
        return False, f"target not reachable: {e}"
    return True, "target reachable"


def check_results(spark: SparkSession, source: Source, specs: Sequence[DatasetSpec],
                  extra: dict[str, Callable[[], tuple[bool, str]]] | None = None,
                  sink=None, newest: str | None = None) -> list[tuple]:
    """``[(check, success, message)]`` for every check; none stops the others."""
    checks: dict[str, Callable[[], tuple[bool, str]]] = {}
    if sink is not None:
        checks["target"] = lambda: check_target(sink)
    checks["source"] = lambda: check_source(spark, source, newest)
    checks["datasets"] = lambda: check_specs(specs)
    checks.update(extra or {})
    rows = []
    for name, fn in checks.items():
        try:
            ok, msg = fn()
        except Exception as e:
            ok, msg = False, str(e)
        rows.append((name, bool(ok), msg))
    return rows


def run_checks(spark: SparkSession, source: Source, specs: Sequence[DatasetSpec],
               extra: dict[str, Callable[[], tuple[bool, str]]] | None = None,
               sink=None) -> DataFrame:
    """The check report as a DataFrame ``(check, success, message)``."""
    return spark.createDataFrame(check_results(spark, source, specs, extra, sink),
                                 CHECKS_SCHEMA)


def require_checks(report: DataFrame | list[tuple]) -> None:
    """Raise ``RuntimeError`` naming every failed check."""
    rows = report.collect() if isinstance(report, DataFrame) else report  # one row per check
    failed = [r for r in rows if not r[1]]
    if failed:
        raise RuntimeError(
            "pre-flight checks failed: " + "; ".join(f"{r[0]}: {r[2]}" for r in failed)
        )
