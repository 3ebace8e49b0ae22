"""Rule-driven projection of nested Parquet columns (rename, flatten, JSON, type override).

The rules become one list of Column expressions handed to a single ``select``; Catalyst
then prunes the scan down to the (nested) fields that are really read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relsync.functions.types import (
    canonical_cast,
    is_nested,
    override_cast,
    to_json_column,
)
from relsync.spec import ColumnRule, DatasetSpec


@dataclass(frozen=True)
class PlannedColumn:
    source: str  # source column (top level)
    name: str  # output column name
    mode: str  # "direct", "flatten" or "json"
    expr: Column
    raw: Column  # the source value itself
    source_type: T.DataType


def _value(col: Column, dt: T.DataType, spec: DatasetSpec) -> tuple[Column, str]:
    """Expression for a (sub-)field value by the default rules: nested -> JSON, else scalar."""
    if is_nested(dt):
        return to_json_column(col, spec.json_as, dt), "json"
    if spec.types == "canonical":
        return canonical_cast(col, dt), "direct"
    return col, "direct"


def _override_type(spec: DatasetSpec, source_name: str, out_name: str) -> str | None:
    # Type overrides may be keyed by the source name or by the output name.
    for key in (source_name, out_name):
        rule = spec.rule(key)
        if rule.type:
            return rule.type
    return None


def plan_columns(schema: T.StructType, spec: DatasetSpec) -> list[PlannedColumn]:
    """Output columns, in source order with flattened fields in place."""
    planned: list[PlannedColumn] = []
    for field in schema.fields:
        name = field.name
        rule: ColumnRule = spec.rule(name)
        final = rule.rename or name
        src = F.col(f"`{name}`")
        if rule.action == "flatten" and isinstance(field.dataType, T.StructType):
            for sub in field.dataType.fields:
                out = f"{final}{spec.sep}{sub.name}"
                value = src.getField(sub.name)
                expr, _ = _value(value, sub.dataType, spec)
                planned.append(PlannedColumn(name, out, "flatten", expr, value, sub.dataType))
            continue
        if is_nested(field.dataType):
            # struct / array / map: JSON unless flattened (flatten on a list falls here too)
            planned.append(PlannedColumn(name, final, "json",
                                         to_json_column(src, spec.json_as, field.dataType),
                                         src, field.dataType))
            continue
        # scalar (action "json" on a scalar is a rename: the value keeps its type)
        expr, mode = _value(src, field.dataType, spec)
        planned.append(PlannedColumn(name, final, mode, expr, src, field.dataType))

    out = []
    seen = set()
    for pc in planned:
        key = pc.name.lower()
        if key in seen:
            raise ValueError(f"projection produces column {pc.name!r} twice")
        seen.add(key)
        t = _override_type(spec, pc.source if pc.mode != "flatten" else pc.name, pc.name)
        expr = pc.expr
        if t:
            # a decimal goes straight to its new type: the canonical one may not hold it
            given = pc.raw if isinstance(pc.source_type, T.DecimalType) else pc.expr
            expr = override_cast(given, t, spec.json_as, pc.source_type)
        out.append(PlannedColumn(pc.source, pc.name, pc.mode, expr.alias(pc.name), pc.raw, pc.source_type))
    return out


def project(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Apply a dataset's projection rules in one narrow ``select`` (no shuffle)."""
    return df.select(*[pc.expr for pc in plan_columns(df.schema, spec)])


def projected_schema(spark: SparkSession, schema: T.StructType, spec: DatasetSpec) -> T.StructType:
    """Schema-only twin of :func:`project` (analysis only, no job runs)."""
    empty = spark.createDataFrame([], schema)
    return project(empty, spec).schema
