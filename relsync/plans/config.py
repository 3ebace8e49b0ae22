"""Dataset specifications and source layout from a TOML / dict configuration.

Existing configuration files with ``[datasets.<name>]`` tables keep working: each becomes a
``DatasetSpec``; the active ``[source.<provider>]`` section becomes a ``Source``.
"""

from __future__ import annotations

import tomllib
from typing import Any, Mapping

from pyspark.sql import SparkSession

from relsync.sources.inventory import list_datasets, suggest_specs
from relsync.spec import DatasetSpec, Source

# Configuration keys understood (names as in existing configuration files).
K_DATASETS = "datasets"
K_PRIMARY_KEY = "primary_key"
K_FINAL_TABLE = "final_table_name"
K_OVERRIDES = "schema_overrides"
K_DATABASE = "database"
K_SEPARATOR = "flatten_separator"
K_EXECUTION = "execution"
K_WORKERS = "max_workers"
K_SOURCE = "source"
K_PROVIDER = "provider"
K_DISCOVERY = "version_discovery_uri"
K_CHECKSUM = "checksum_uri_template"
K_DATA = "data_uri_template"
K_DATASET_DISCOVERY = "dataset_discovery_uri_template"

# fsspec spells Google Cloud Storage "gcs://"; Hadoop's connector uses "gs://"
_SCHEMES = {"gcs://": "gs://", "s3://": "s3a://"}


def load_config(path: str) -> dict[str, Any]:
    with open(path, "rb") as f:
        return tomllib.load(f)


def _hadoop_uri(uri: str | None) -> str | None:
    if uri is None:
        return None
    for old, new in _SCHEMES.items():
        if uri.startswith(old):
            return new + uri[len(old):]
    return uri


def specs_from_config(cfg: Mapping[str, Any]) -> list[DatasetSpec]:
    sep = cfg.get(K_DATABASE, {}).get(K_SEPARATOR, "_")
    specs = []
    for name, d in cfg.get(K_DATASETS, {}).items():
        specs.append(DatasetSpec(
            name,
            primary_key=tuple(d.get(K_PRIMARY_KEY, ())),
            final_table=d.get(K_FINAL_TABLE),
            overrides=d.get(K_OVERRIDES, {}),
            sep=sep,
        ))
    return specs


def source_from_config(cfg: Mapping[str, Any]) -> Source:
    """The active provider's section (falling back to top-level keys) as a ``Source``."""
    src = dict(cfg.get(K_SOURCE, {}))
    provider = src.get(K_PROVIDER)
    section = {**{k: v for k, v in src.items() if not isinstance(v, dict)},
               **(src.get(provider, {}) if provider else {})}
    root = _hadoop_uri(section.get(K_DISCOVERY))
    if not root:
        raise ValueError(f"source needs {K_DISCOVERY}")
    return Source(root=root.rstrip("/"),
                  release_template=_hadoop_uri(section.get(K_CHECKSUM)),
                  data_template=_hadoop_uri(section.get(K_DATA)),
                  datasets_template=_hadoop_uri(section.get(K_DATASET_DISCOVERY)))


def max_workers(cfg: Mapping[str, Any]) -> int:
    return int(cfg.get(K_EXECUTION, {}).get(K_WORKERS, 1))


def suggest_config(spark: SparkSession, source: Source, version: str,
                   default_key: str = "id") -> str:
    """``[datasets.<name>]`` TOML for every dataset of a release (key ``id`` by default),
    ready to edit and to read back with :func:`specs_from_config`."""
    rows = suggest_specs(list_datasets(spark, source, version), default_key).collect()
    out = []
    for r in rows:  # one row per dataset
        out += [f'[{K_DATASETS}."{r["dataset"]}"]',
                f'{K_PRIMARY_KEY} = ["{r["primary_key"]}"]',
                f'{K_FINAL_TABLE} = "{r["final_table_name"]}"', ""]
    return "\n".join(out)
