"""relsync: keep catalog tables equal to the newest release of nested Parquet datasets.

Every step is a DataFrame operator; Spark owns planning, shuffles and parallelism.

Entry points::

    from relsync import DatasetSpec, Source, CatalogSink, load_release
    from relsync import project, check_primary_key, merge_snapshot, diff_snapshots
"""

from relsync.operators.checks import check_foreign_key, check_primary_key, key_violations, orphan_keys
from relsync.operators.evolve import align, schema_diff
from relsync.operators.merge import diff_snapshots, merge_snapshot, merge_stats, stale_rows
from relsync.operators.projection import project, projected_schema
from relsync.plans.release_load import load_dataset, load_release
from relsync.plans.sink import CatalogSink, Sink
from relsync.spec import ColumnRule, DatasetSpec, Source

__all__ = [
    "CatalogSink", "ColumnRule", "DatasetSpec", "Sink", "Source",
    "align", "check_foreign_key", "check_primary_key", "diff_snapshots", "key_violations",
    "load_dataset", "load_release", "merge_snapshot", "merge_stats", "orphan_keys", "project",
    "projected_schema", "schema_diff", "stale_rows",
]
__version__ = "0.1.0"
