"""Key checks Spark does not enforce: primary key (null / duplicate) and foreign key (orphans).

Both are aggregations with map-side partial aggregation before the shuffle, so a hot
key (even one holding a third of the rows) collapses to one partial row per task and
never gathers in a single task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType


class KeyViolation(ValueError):
    """Raised when a key check finds violations; ``sample`` holds a few offending rows."""

    def __init__(self, message: str, sample: list | None = None):
        super().__init__(message)
        self.sample = sample or []


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def _any_null(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.isNull() for c in _cols(names)])


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows ``(keys..., reason, n)`` for every key value that is null in a part or repeated.

    reason is ``null_key`` (n rows share that partly-null key) or ``duplicate_key``
    (n > 1 rows share the key). One aggregation, one shuffle of key columns only.
    """
    if not keys:
        raise ValueError("a primary key needs at least one column")
    # a key column may itself be called n or reason
    counted = df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias("__n"))
    null_part = _any_null(keys)
    return counted.where(null_part | (F.col("__n") > 1)).select(
        *_cols(keys),
        F.when(null_part, F.lit("null_key")).otherwise(F.lit("duplicate_key")).alias("reason"),
        F.col("__n").alias("n"),
    )


def check_primary_key(df: DataFrame, keys: Sequence[str], sample: int = 5) -> None:
    """Raise :class:`KeyViolation` when the key has a null part or a duplicate."""
    rows = key_violations(df, keys).take(sample)
    if rows:
        desc = "; ".join(
            f"{r[len(keys)]} {tuple(r[:len(keys)])} x{r[-1]}" for r in rows
        )
        raise KeyViolation(f"primary key {tuple(keys)} violated: {desc}", rows)


def orphan_keys(
    child: DataFrame,
    parent: DataFrame,
    child_cols: Sequence[str],
    parent_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Foreign-key values of ``child`` with no parent row: ``(child_cols..., n)``.

    A null in any part of the foreign key passes (SQL MATCH SIMPLE). The child side is
    pre-aggregated per key before the anti join, so a heavily referenced parent costs one
    partial row per task, not a hot partition.
    """
    parent_cols = list(parent_cols or child_cols)
    if len(parent_cols) != len(child_cols):
        raise ValueError("foreign key and referenced key differ in length")
    refs = (
        child.where(~_any_null(child_cols))
        .groupBy(*_cols(child_cols))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    pk = parent.select(
        *[F.col(f"`{p}`").alias(f"__pk{i}") for i, p in enumerate(parent_cols)]
    )
    cond = reduce(
        lambda a, b: a & b,
        [refs[f"`{c}`"] == pk[f"__pk{i}"] for i, c in enumerate(child_cols)],
    )
    # ``__n > 0`` always holds; naming the aggregate in the condition keeps the optimizer
    # from pushing the anti join below the aggregation, which would shuffle every child
    # row (a hot key included) instead of one partial count per key and task.
    found = refs.join(pk, cond & (refs["__n"] > 0), "left_anti")
    return found.select(*_cols(child_cols), F.col("__n").alias("n"))


def orphan_rows(
    child: DataFrame,
    parent: DataFrame,
    child_cols: Sequence[str],
    parent_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Child rows whose non-null foreign key has no parent (AQE splits skewed keys)."""
    parent_cols = list(parent_cols or child_cols)
    pk = parent.select(
        *[F.col(f"`{p}`").alias(f"__pk{i}") for i, p in enumerate(parent_cols)]
    )
    cond = reduce(
        lambda a, b: a & b,
        [child[f"`{c}`"] == pk[f"__pk{i}"] for i, c in enumerate(child_cols)],
    )
    return child.where(~_any_null(child_cols)).join(pk, cond, "left_anti")


def check_foreign_key(
    child: DataFrame,
    parent: DataFrame,
    child_cols: Sequence[str],
    parent_cols: Sequence[str] | None = None,
    sample: int = 5,
) -> None:
    rows = orphan_keys(child, parent, child_cols, parent_cols).take(sample)
    if rows:
        desc = "; ".join(f"{tuple(r[:-1])} x{r[-1]}" for r in rows)
        raise KeyViolation(f"foreign key {tuple(child_cols)} has orphans: {desc}", rows)


@dataclass(frozen=True)
class Reference:
    """Columns of a table that must be found in another one."""

    columns: tuple[str, ...]
    parent: DataFrame
    parent_columns: tuple[str, ...]


def _key_text(values: Sequence[Column]) -> Column:
    return F.to_json(F.array(*[v.cast("string") for v in values]))


def _types(df: DataFrame, names: Sequence[str]) -> list[DataType]:
    return [f.dataType for f in df.select(*_cols(names)).schema]


def _entry(check: int, columns: Sequence[Column], values: Sequence[Column], whole: Sequence[bool]) -> dict[str, Column]:
    """What is counted of one check: its number, negative if one of ``columns`` is null, and its
    ``values``, in slots of its own for whole numbers (``whole``) and for texts."""
    null = reduce(lambda a, b: a | b, [c.isNull() for c in columns])
    entry, used = {"__check": F.when(null, F.lit(-check)).otherwise(F.lit(check))}, [0, 0]
    for value, w in zip(values, whole):
        entry[f"__{'n' if w else 't'}{used[w]}"] = value.cast("long") if w else F.make_valid_utf8(value.cast("string"))
        used[w] += 1
    return entry


def key_report(df: DataFrame, unique: Mapping[str, Sequence[str]], references: Mapping[str, Reference]) -> DataFrame:
    """``(check, reason, key, n)``: every violation of all named keys and references of a table, in
    one pass over it.

    reason is ``null_key`` or ``duplicate_key`` (as ``key_violations``) for a name of ``unique``, and
    ``orphan`` (as ``orphan_keys``; a null part passes) for a name of ``references``. ``key`` is the JSON
    text of the values, those of a reference in the type of the parent's columns where they have one.
    Names must differ. Each row is expanded to its keys, the parents' keys are set beside them, and all
    are counted per key by one aggregation, with partial counts per task, so a hot key costs a row a task.
    Whole numbers are counted as such; only the keys reported become text.
    """
    if set(unique) & set(references) or not (unique or references):
        raise ValueError("checks need names of their own, and at least one")
    names, entries, parents = [*unique, *references], [], []
    for i, (name, columns) in enumerate(unique.items(), 1):
        if not columns:
            raise ValueError("a key needs at least one column")
        whole = [isinstance(t, IntegralType) for t in _types(df, columns)]
        entries.append(_entry(i, _cols(columns), _cols(columns), whole))
    for i, (name, ref) in enumerate(references.items(), len(unique) + 1):
        if len(ref.columns) != len(ref.parent_columns):
            raise ValueError("foreign key and referenced key differ in length")
        kinds = _types(ref.parent, ref.parent_columns)
        whole = [isinstance(t, IntegralType) and isinstance(own, IntegralType) for own, t in zip(_types(df, ref.columns), kinds)]
        values = [c if w else F.coalesce(c.try_cast(t).cast("string"), c.cast("string"))
                  for c, t, w in zip(_cols(ref.columns), kinds, whole)]
        entries.append(_entry(i, _cols(ref.columns), values, whole))
        parents.append((ref.parent, _entry(i, _cols(ref.parent_columns), _cols(ref.parent_columns), whole)))
    # a number leads where there is one: a task that has to spill sorts by the first column's prefix
    slots = sorted({s for e in entries for s in e if s != "__check"})
    empty = {s: F.lit(None).cast("long" if s.startswith("__n") else "string") for s in slots}

    def row(entry: dict[str, Column]) -> list[Column]:
        return [{**empty, **entry}[s].alias(s) for s in [*slots, "__check"]]

    # the keys of a scan's task outgrow its memory and would nearly all be sorted and spilled; dealt
    # evenly over the shuffle's partitions, without columns of no check, they are counted in memory
    df = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = df.select(F.inline(F.array(*[F.struct(*row(e)) for e in entries]))).withColumn("__child", F.lit(True))
    for parent, entry in parents:
        rows = rows.unionByName(parent.select(*row(entry), F.lit(False).alias("__child")))
    counted = rows.groupBy(*slots, "__check").agg(
        F.count(F.when(F.col("__child"), 1)).alias("n"), F.bool_and("__child").alias("__alone"))
    check, is_unique = F.abs("__check"), F.abs("__check") <= len(unique)
    reason = (F.when(is_unique & (F.col("__check") < 0), "null_key").when(is_unique & (F.col("n") > 1), "duplicate_key")
              .when(~is_unique & (F.col("__check") > 0) & F.col("__alone"), "orphan"))
    key = reduce(lambda a, b: a.when(check == b[0], _key_text([F.col(s) for s in b[1] if s != "__check"])), enumerate(entries, 1), F)
    return counted.withColumn("reason", reason).where("reason IS NOT NULL").select(
        F.element_at(F.array(*map(F.lit, names)), check).alias("check"), "reason", key.alias("key"), "n")


def check_keys(df: DataFrame, unique: Mapping[str, Sequence[str]], references: Mapping[str, Reference], sample: int = 5) -> None:
    """Raise :class:`KeyViolation` when ``key_report`` finds anything: one job for all keys of a table."""
    rows = key_report(df, unique, references).take(sample) if unique or references else []
    if rows:
        raise KeyViolation("; ".join(f"{r['check']}: {r['reason']} {r['key']} x{r['n']}" for r in rows), rows)
