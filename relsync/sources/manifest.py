"""Checksum manifest of a release: ``<sha1><whitespace><relative path>`` per line.

The manifest itself is trusted only when its SHA-1 equals the first token of the
``.sha1`` file next to it. Lines are parsed in parallel; when a path is listed twice,
the later line wins, so every line keeps its position in the file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relsync.operators.integrity import hash_files
from relsync.sources.files import ARROW_SCHEMES, split_uri
from relsync.sources.inventory import file_inventory
from relsync.sources.remote import remote_lines
from relsync.spec import Source

# Line layout "hash, whitespace, path"; leading "." and "/" are stripped from paths.
LINE_PATTERN = r"^\s*(\S+)\s+(.*?)\s*$"
LEADING_DOTS_SLASHES = r"^[./]+"


class ManifestError(ValueError):
    pass


def parse_manifest_lines(lines: DataFrame, value: str = "value",
                         keep: tuple[str, ...] = ()) -> DataFrame:
    """``(path, sha1, *keep)`` from a DataFrame of manifest lines; blank lines are skipped."""
    line = F.col(value)
    return (
        lines.where(F.trim(line) != "")
        .select(
            F.regexp_replace(F.regexp_extract(line, LINE_PATTERN, 2), LEADING_DOTS_SLASHES, "")
            .alias("path"),
            F.lower(F.regexp_extract(line, LINE_PATTERN, 1)).alias("sha1"),
            *keep,
        )
    )


def last_listing_wins(parsed: DataFrame, order: str = "__pos") -> DataFrame:
    """``(path, sha1)``: for a path listed more than once, the hash of its latest line.

    ``max_by`` aggregates partially before the shuffle, so a path repeated on a third of
    the lines still costs one partial row per task.
    """
    return parsed.groupBy("path").agg(F.max_by("sha1", order).alias("sha1"))


def _lines(spark: SparkSession, path: str, through=None) -> DataFrame:
    return spark.read.text(path) if through is None else remote_lines(spark, path, through)


def read_manifest(spark: SparkSession, path: str, through=None) -> DataFrame:
    """``(path, sha1)``, one row per listed path, the last listing of a path winning.

    Line order is (split start offset, row id within the split), which is file order
    however the text source splits the file; a remote file is streamed by one task.
    """
    if through is not None:
        return last_listing_wins(parse_manifest_lines(remote_lines(spark, path, through), keep=("pos",)), "pos")
    lines = spark.read.text(path).select(
        "value",
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
        .alias("__pos"),
    )
    return last_listing_wins(parse_manifest_lines(lines, keep=("__pos",)))


def path_conflicts(parsed: DataFrame) -> DataFrame:
    """``(path, n, n_hashes)`` for paths listed more than once."""
    return (
        parsed.groupBy("path")
        .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("sha1").alias("n_hashes"))
        .where(F.col("n") > 1)
    )


def manifest_conflicts(spark: SparkSession, path: str) -> DataFrame:
    """Paths a manifest file lists more than once (the last one wins on load)."""
    return path_conflicts(parse_manifest_lines(spark.read.text(path)))


def manifest_digest(spark: SparkSession, path: str, filesystem=None, through=None) -> DataFrame:
    """``(path, sha1)`` of the manifest file's bytes: one task streams it, whatever its size. Only where
    no file system is known to open it (see ``sources.files``) it is read as one value."""
    if filesystem is not None or split_uri(path)[0] in ARROW_SCHEMES:
        inventory = file_inventory(spark, path, through=through)
        return hash_files(spark, path, filesystem=filesystem, inventory=inventory).select("path", "sha1")
    return spark.read.format("binaryFile").load(path).select("path", F.sha1("content").alias("sha1"))


def verify_manifest(spark: SparkSession, source: Source, version: str) -> None:
    """Raise :class:`ManifestError` unless the manifest's SHA-1 matches its ``.sha1`` file."""
    expected_rows = (
        _lines(spark, source.manifest_hash(version), source.through)
        .where(F.trim("value") != "")
        .select(F.lower(F.split(F.trim("value"), r"\s+").getItem(0)).alias("sha1"))
        .take(1)
    )
    if not expected_rows:
        raise ManifestError(f"empty checksum file {source.manifest_hash(version)}")
    actual = manifest_digest(spark, source.manifest(version), source.filesystem, source.through).take(1)
    if not actual:
        raise ManifestError(f"manifest {source.manifest(version)} not found")
    if actual[0]["sha1"] != expected_rows[0]["sha1"]:
        raise ManifestError(
            f"checksum mismatch for manifest {source.manifest(version)}: "
            f"expected {expected_rows[0]['sha1']}, got {actual[0]['sha1']}"
        )


def malformed_lines(spark: SparkSession, path: str, through=None) -> DataFrame:
    """Non-blank manifest lines without both a hash and a path."""
    lines = _lines(spark, path, through)
    return lines.where((F.trim("value") != "") & ~F.col("value").rlike(r"^\s*\S+\s+\S"))


def load_manifest(spark: SparkSession, source: Source, version: str) -> DataFrame:
    """Verify the manifest of a release, then return its ``(path, sha1)`` entries.

    A line without both a hash and a path makes the manifest unusable (raises).
    """
    verify_manifest(spark, source, version)
    bad = malformed_lines(spark, source.manifest(version), source.through).take(3)
    if bad:
        raise ManifestError(f"malformed manifest lines: {[r['value'] for r in bad]}")
    return read_manifest(spark, source.manifest(version), source.through)


def select_dataset(manifest: DataFrame, source: Source, dataset: str,
                   files: list[str] | None = None) -> DataFrame:
    """Manifest entries of one dataset, optionally only the named files."""
    prefix = source.relative_prefix(dataset)
    out = manifest.where(F.col("path").startswith(prefix))
    if files:
        out = out.where(F.substring_index("path", "/", -1).isin(list(files)))
    return out
