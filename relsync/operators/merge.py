"""Snapshot merge: make a table equal to a new release, by key.

Deleting the rows whose key is gone and then inserting-or-updating every staging row
leaves exactly *the staging rows, plus the table-only columns carried over by key*::

    merged = staging LEFT JOIN final[keys + columns only in final] USING (keys)

so the merge is one left join, or no join at all when no column was removed. Keys must
be non-null and unique in staging, and in the table where its columns are carried over or
compared; both are checked by default (``checks.check_primary_key``). Unique keys also mean no
join key can be hot.
"""

from __future__ import annotations

import uuid
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from relsync.functions.types import comparable, json_text
from relsync.operators.checks import check_primary_key
from relsync.operators.evolve import conform, diff_schemas, store_assignable, store_cast

OPS = ("insert", "update", "delete", "unchanged")


def _require_keys(df: DataFrame, keys: Sequence[str], side: str) -> None:
    have = {c.lower() for c in df.columns}
    missing = [k for k in keys if k.lower() not in have]
    if missing:
        raise ValueError(f"key column(s) {missing} missing in {side}")


def merge_snapshot(staging: DataFrame, final: DataFrame | None, keys: Sequence[str],
                   check_keys: bool = True) -> DataFrame:
    """Rows and columns of the table after a delta load of ``staging`` into ``final``.

    * rows: exactly the staging keys (vanished keys deleted, new keys inserted);
    * columns: final's columns in final's order and types, then new columns by name;
    * a column only in ``final`` keeps its value for kept keys and is NULL for new keys;
    * when every column is a key the new rows are still inserted.

    The key is checked first, by one aggregation over key columns: in staging, and in the
    table if columns are carried over from it (a repeated key would multiply rows).
    """
    keys = list(keys)
    _require_keys(staging, keys, "staging")
    if check_keys:
        check_primary_key(staging, keys)
    if final is None:
        return staging
    _require_keys(final, keys, "final")
    d = diff_schemas(staging.schema, final.schema)
    if not d.removed:
        return conform(staging, final.schema)
    if check_keys:
        check_primary_key(final, keys)
    carry = final.select(*[F.col(f"`{c}`") for c in keys + list(d.removed)])
    joined = staging.join(carry, on=keys, how="left")
    return conform(staging, final.schema, carried=joined)


def replace_snapshot(staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full refresh: the table becomes ``staging`` as it is (its own columns and types).

    The key is checked first (one aggregation over the key columns); a null or duplicate
    key raises before anything could be published.
    """
    keys = list(keys)
    _require_keys(staging, keys, "staging")
    check_primary_key(staging, keys)
    return staging


def _distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    # partial aggregation collapses a repeated key per task before the shuffle, and the
    # semi / anti join reuses that hash partitioning on the key
    return df.select(*[F.col(f"`{k}`") for k in keys]).distinct()


def stale_rows(final: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``final`` whose key is absent from ``staging`` (the rows a delta load deletes)."""
    keys = list(keys)
    return final.join(_distinct_keys(staging, keys), on=keys, how="left_anti")


def kept_rows(final: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``final`` whose key is still present in ``staging``."""
    keys = list(keys)
    return final.join(_distinct_keys(staging, keys), on=keys, how="left_semi")


def _shared_values(staging: DataFrame, final: DataFrame, keys: Sequence[str]) -> tuple[list[str], list[Column], list[Column]]:
    """The columns both sides have beside the key, and their comparable values on either side, the
    staging value taken in the table's type."""
    d = diff_schemas(staging.schema, final.schema)
    key_l = {k.lower() for k in keys}
    shared = [c for c in d.common if c.lower() not in key_l]
    ftype = {f.name.lower(): f.dataType for f in final.schema.fields}
    stype = {f.name.lower(): f.dataType for f in staging.schema.fields}
    changed = {c.lower() for c in d.type_changed}

    def stored(c: str) -> Column:
        have, want = stype[c.lower()], ftype[c.lower()]
        if c.lower() not in changed:
            return F.col(f"`{c}`")
        if not store_assignable(have, want):
            raise TypeError(f"column {c!r}: {have.simpleString()} values cannot be compared with the table's {want.simpleString()} column")
        return store_cast(F.col(f"`{c}`"), have, want, c)

    s_vals = [comparable(stored(c), ftype[c.lower()]) for c in shared]
    f_vals = [comparable(F.col(f"`{c}`"), ftype[c.lower()]) for c in shared]
    return shared, s_vals, f_vals


def _operation(values: int) -> Column:
    """insert / update / delete / unchanged of a joined row, by its ``__s`` and ``__f`` values."""
    same: Column = reduce(
        lambda a, b: a & b,
        [F.col(f"__s{i}").eqNullSafe(F.col(f"__f{i}")) for i in range(values)],
        F.lit(True),
    )
    return (
        F.when(F.col("__in_f").isNull(), F.lit("insert"))
        .when(F.col("__in_s").isNull(), F.lit("delete"))
        .when(same, F.lit("unchanged"))
        .otherwise(F.lit("update"))
    )


def diff_snapshots(staging: DataFrame, final: DataFrame, keys: Sequence[str],
                   compare: str = "exact", check_keys: bool = True) -> DataFrame:
    """``(keys..., op)`` with op insert / update / delete / unchanged for every key of either side.

    A kept key is ``update`` when any column both sides share differs (null-safe), the
    staging value taken in the table's type, as the merge would store it. One full outer
    join on the key; both sides carry only key + shared columns.

    Keys must be unique on both sides: ``check_keys`` checks both first (one aggregation each),
    since a repeated key would pair all its rows, in one task.

    ``compare="digest"`` shuffles a SHA-256 (32 bytes) of the shared columns' JSON instead of
    the columns themselves, which pays for wide rows only; it tells -0.0 from 0.0, which exact
    comparison treats as equal. Maps compare by their entries, variants by their JSON text.
    """
    if compare not in ("exact", "digest"):
        raise ValueError("compare must be exact or digest")
    keys = list(keys)
    _require_keys(staging, keys, "staging")
    _require_keys(final, keys, "final")
    if check_keys:
        check_primary_key(staging, keys)
        check_primary_key(final, keys)
    shared, s_vals, f_vals = _shared_values(staging, final, keys)
    if compare == "digest" and shared:
        def digest(vals):
            row = F.struct(*[v.alias(f"c{i}") for i, v in enumerate(vals)])
            return [F.unhex(F.sha2(json_text(row), 256))]
        s_vals, f_vals, shared = digest(s_vals), digest(f_vals), ["__digest"]
    s = staging.select(
        *[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)],
        *[v.alias(f"__s{i}") for i, v in enumerate(s_vals)],
        F.lit(True).alias("__in_s"),
    )
    f = final.select(
        *[F.col(f"`{k}`").alias(f"__j{i}") for i, k in enumerate(keys)],
        *[v.alias(f"__f{i}") for i, v in enumerate(f_vals)],
        F.lit(True).alias("__in_f"),
    )
    cond = reduce(lambda a, b: a & b, [F.col(f"__k{i}") == F.col(f"__j{i}") for i in range(len(keys))])
    op = _operation(len(shared))
    return s.join(f, cond, "full_outer").select(
        *[F.coalesce(F.col(f"__k{i}"), F.col(f"__j{i}")).alias(k) for i, k in enumerate(keys)],
        op.alias("op"),
    )


def merge_counted(staging: DataFrame, final: DataFrame, keys: Sequence[str],
                  check_keys: bool = True) -> tuple[DataFrame, Observation]:
    """``merge_snapshot`` into an existing table that also counts what it does: the merged rows, and
    an observation that has, once they were written, a metric for each of insert, update, delete
    and unchanged (the meaning of ``diff_snapshots``).

    One plan: a full outer join on the key, whose vanished rows are counted and left out, so both
    sides are shuffled once and nothing is read again. A stage that runs again after lost executors
    can count twice; whoever needs certainty compares the metrics with the rows written.
    """
    keys = list(keys)
    _require_keys(staging, keys, "staging")
    _require_keys(final, keys, "final")
    if check_keys:
        check_primary_key(staging, keys)
        check_primary_key(final, keys)
    d = diff_schemas(staging.schema, final.schema)
    shared, s_vals, f_vals = _shared_values(staging, final, keys)
    table_side = final.select(
        *[F.col(f"`{k}`").alias(f"__j{i}") for i, k in enumerate(keys)],
        *[v.alias(f"__f{i}") for i, v in enumerate(f_vals)],
        *[F.col(f"`{c}`") for c in d.removed],
        F.lit(True).alias("__in_f"),
    )
    rows = staging.withColumns({"__in_s": F.lit(True), **{f"__s{i}": v for i, v in enumerate(s_vals)}})
    cond = reduce(lambda a, b: a & b, [F.col(f"`{k}`") == F.col(f"__j{i}") for i, k in enumerate(keys)])
    observed = Observation(f"merge_{uuid.uuid4().hex[:8]}")
    op = _operation(len(shared))
    joined = rows.join(table_side, cond, "full_outer").withColumn("__op", op)
    joined = joined.observe(observed, *[F.count_if(F.col("__op") == o).alias(o) for o in OPS])
    return conform(staging, final.schema, carried=joined.where("__op <> 'delete'")), observed


def change_rows(new: DataFrame, old: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """``(op, columns of new...)``: what turns the rows of ``old`` into those of ``new``, by key.

    op is insert or update (the row of ``new``) or delete (the row of ``old``, in the columns of
    ``new``); unchanged rows are left out. Applied to ``old`` by key, the result is ``new``. Columns
    that ``old`` lacks are null in it; a value that its type cannot give the type of ``new`` is null
    too, so the row counts as updated. Keys must be unique on both sides. One full outer join.
    """
    keys = list(keys)
    _require_keys(new, keys, "new")
    if old is None:
        return new.select(F.lit("insert").alias("op"), *[F.col(f"`{c}`") for c in new.columns])
    _require_keys(old, keys, "old")
    have = {f.name.lower(): f for f in old.schema.fields}

    def before(f) -> Column:
        was = have.get(f.name.lower())
        if was is None:
            return F.lit(None).cast(f.dataType)
        value = F.col(f"`{was.name}`")
        return value if was.dataType == f.dataType else value.try_cast(f.dataType)

    fields = new.schema.fields
    is_key = {k.lower() for k in keys}
    a = new.select(F.lit(True).alias("__in_s"), *[F.col(f"`{f.name}`").alias(f"__s{i}") for i, f in enumerate(fields)])
    b = old.select(F.lit(True).alias("__in_f"), *[before(f).alias(f"__f{i}") for i, f in enumerate(fields)])
    at = [i for i, f in enumerate(fields) if f.name.lower() in is_key]
    cond = reduce(lambda x, y: x & y, [F.col(f"__s{i}") == F.col(f"__f{i}") for i in at])
    same = reduce(lambda x, y: x & y, [
        comparable(F.col(f"__s{i}"), f.dataType).eqNullSafe(comparable(F.col(f"__f{i}"), f.dataType))
        for i, f in enumerate(fields) if i not in at], F.lit(True))
    op = (F.when(F.col("__in_f").isNull(), F.lit("insert")).when(F.col("__in_s").isNull(), F.lit("delete"))
          .when(~same, F.lit("update")))
    gone = F.col("op") == "delete"
    return a.join(b, cond, "full_outer").withColumn("op", op).where("op is not null").select(
        "op", *[F.when(gone, F.col(f"__f{i}")).otherwise(F.col(f"__s{i}")).alias(f.name) for i, f in enumerate(fields)])


def merge_stats(staging: DataFrame, final: DataFrame, keys: Sequence[str],
                compare: str = "exact", check_keys: bool = True) -> DataFrame:
    """``(op, n)``: how many keys a delta load inserts, updates, deletes or leaves unchanged."""
    return (diff_snapshots(staging, final, keys, compare, check_keys)
            .groupBy("op").agg(F.count(F.lit(1)).alias("n")))


def merge_counts(staging: DataFrame, final: DataFrame, keys: Sequence[str],
                 check_keys: bool = True) -> dict:
    """Counts as a dict; ``upserted`` = every staging row, ``deleted`` = vanished keys."""
    counts = {op: 0 for op in OPS}
    for r in merge_stats(staging, final, keys, check_keys=check_keys).collect():  # at most four rows
        counts[r["op"]] = r["n"]
    counts["deleted"] = counts["delete"]
    counts["upserted"] = counts["insert"] + counts["update"] + counts["unchanged"]
    return counts
