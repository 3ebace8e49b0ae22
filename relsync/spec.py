"""Dataset specifications and release-source layout."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Any, Mapping

ACTIONS = (None, "flatten", "json")


@dataclass(frozen=True)
class ColumnRule:
    """Projection rule for one source column.

    rename  new column name (also the prefix of flattened sub-fields)
    action  None (direct), "flatten" (one struct level) or "json" (serialise)
    type    SQL type name the output column is cast to (e.g. "TEXT", "NUMERIC(10,2)")
    """

    rename: str | None = None
    action: str | None = None
    type: str | None = None

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"unknown action {self.action!r}; expected one of {ACTIONS}")

    @classmethod
    def of(cls, value: "ColumnRule | Mapping | None") -> "ColumnRule":
        if value is None:
            return cls()
        if isinstance(value, ColumnRule):
            return value
        unknown = set(value) - {"rename", "action", "type"}
        if unknown:
            raise ValueError(f"unknown rule keys {sorted(unknown)}")
        return cls(**dict(value))


@dataclass(frozen=True)
class ForeignKey:
    """Columns of a dataset's table that refer to another table's columns (output names)."""

    columns: tuple[str, ...]
    table: str
    references: tuple[str, ...]

    def __post_init__(self):
        for name in ("columns", "references"):
            value = getattr(self, name)
            object.__setattr__(self, name, (value,) if isinstance(value, str) else tuple(value))
        if not self.columns or len(self.columns) != len(self.references):
            raise ValueError("a foreign key names as many columns as it references, and at least one")


@dataclass(frozen=True)
class DatasetSpec:
    """How one dataset of a release becomes one table.

    primary_key   key columns, named as in the *source* (renames are followed)
    final_table   table name; default is the dataset name with '-' replaced by '_'
    overrides     column name -> ColumnRule (or a dict with rename/action/type)
    sep           separator between a flattened struct's name and its fields
    json_as       "string" (JSON text), "variant" (VariantType) or "native" (keep nested)
    types         "canonical" (widen ints to bigint, floats to double, ...) or "native"
    foreign_keys  checked against the referenced tables before a load is published
    """

    name: str
    primary_key: tuple[str, ...] = ()
    final_table: str | None = None
    overrides: Mapping[str, ColumnRule] = field(default_factory=dict)
    sep: str = "_"
    json_as: str = "string"
    types: str = "canonical"
    foreign_keys: tuple[ForeignKey, ...] = ()

    def __post_init__(self):
        object.__setattr__(self, "foreign_keys", tuple(
            k if isinstance(k, ForeignKey) else ForeignKey(**dict(k)) for k in self.foreign_keys))
        keys = self.primary_key
        if isinstance(keys, str):
            keys = (keys,)
        object.__setattr__(self, "primary_key", tuple(keys))
        object.__setattr__(
            self, "overrides", {k: ColumnRule.of(v) for k, v in dict(self.overrides).items()}
        )
        if self.json_as not in ("string", "variant", "native"):
            raise ValueError(f"json_as must be string, variant or native, not {self.json_as!r}")
        if self.types not in ("canonical", "native"):
            raise ValueError(f"types must be canonical or native, not {self.types!r}")

    @property
    def table_name(self) -> str:
        return self.final_table or self.name.replace("-", "_")

    def rule(self, column: str) -> ColumnRule:
        """The rule of a column; names compare case-insensitively, an exact one first."""
        if column in self.overrides:
            return self.overrides[column]
        return next((r for c, r in self.overrides.items() if c.lower() == column.lower()), ColumnRule())

    def output_key(self) -> tuple[str, ...]:
        """Key column names after renames (a key must not be flattened)."""
        out = []
        for k in self.primary_key:
            rule = self.rule(k)
            if rule.action == "flatten":
                raise ValueError(f"key column {k!r} cannot be flattened")
            out.append(rule.rename or k)
        return tuple(out)


@dataclass(frozen=True)
class Source:
    """Layout of a release tree on any Hadoop-compatible file system.

    Default layout, all under ``root``::

        <root>/<version>/output/etl/parquet/<dataset>/<file>.parquet
        <root>/<version>/release_data_integrity          (manifest: "<sha1>  <relative path>")
        <root>/<version>/release_data_integrity.sha1     (hash of the manifest)

    Checksums and data may live elsewhere (e.g. checksums on one server, data in an object
    store): ``release_template`` is the folder holding a release's manifest and
    ``data_template`` a dataset's folder, with ``{version}`` and ``{dataset_name}``
    placeholders. Manifest keys stay relative: ``<parquet_dir>/<dataset>/<file>``.
    ``datasets_template`` (``{version}``) is the folder whose subfolders are the datasets,
    where it is not the data template's parent.

    ``filesystem`` opens files inside tasks for footers and checksums where the scheme alone
    does not tell how (see ``sources.files``); Spark's own readers use Hadoop's configuration.
    ``remote`` reads everything through it, for ``ftp``, ``http`` or anonymous access that Spark
    cannot list or read (see ``sources.remote``).
    """

    root: str
    # Where a release keeps its Parquet datasets, and its manifest's name.
    parquet_dir: str = "output/etl/parquet"
    manifest_name: str = "release_data_integrity"
    release_template: str | None = None
    data_template: str | None = None
    datasets_template: str | None = None
    filesystem: Any = None
    remote: bool = False

    def __post_init__(self):
        if self.remote and self.filesystem is None:
            raise ValueError("a remote source needs a filesystem")

    @property
    def through(self) -> Any:
        """The file system that every read goes through; None where Spark reads by itself."""
        return self.filesystem if self.remote else None

    def release(self, version: str) -> str:
        if self.release_template:
            return self.release_template.format(version=version).rstrip("/")
        return f"{self.root.rstrip('/')}/{version}"

    def parquet_root(self, version: str) -> str:
        """The folder that holds the datasets' folders."""
        if self.datasets_template:
            return self.datasets_template.format(version=version).rstrip("/")
        if self.data_template:
            head = self.data_template.split("{dataset_name}", 1)[0]
            return head[:head.rindex("/")].format(version=version)
        return f"{self.release(version)}/{self.parquet_dir}"

    def dataset_dir(self, version: str, dataset: str) -> str:
        if self.data_template:
            return self.data_template.format(version=version, dataset_name=dataset).rstrip("/")
        return f"{self.parquet_root(version)}/{dataset}"

    def manifest(self, version: str) -> str:
        return f"{self.release(version)}/{self.manifest_name}"

    def manifest_hash(self, version: str) -> str:
        return f"{self.manifest(version)}.sha1"

    def manifest_glob(self) -> str:
        """Glob matching the manifest of every release."""
        return self.manifest("*")

    def version_regex(self) -> str:
        """Regex whose group 1 is the release name in a manifest path (qualified or not)."""
        marker = "VERSION_MARKER"
        tail = self.manifest(marker).split("://", 1)[-1]
        return re.escape(tail).replace(marker, "([^/]+)").lstrip("/") + "$"

    def relative_prefix(self, dataset: str) -> str:
        """Manifest key prefix of a dataset's files."""
        return f"{self.parquet_dir}/{dataset}/"
