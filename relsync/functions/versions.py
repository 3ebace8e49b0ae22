"""Release version names: ``YY.MM``, ordered by their two integers, newest first."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a release directory name is exactly two digits, a dot, two digits.
VERSION_PATTERN = r"^\d{2}\.\d{2}$"


def is_version(col: Column) -> Column:
    return col.rlike(VERSION_PATTERN)


def version_major(col: Column) -> Column:
    return F.split(col, r"\.").getItem(0).cast("int")


def version_minor(col: Column) -> Column:
    return F.split(col, r"\.").getItem(1).cast("int")


def newest_first(col: Column) -> list[Column]:
    """Sort expressions: numeric, not text, order; descending."""
    return [version_major(col).desc(), version_minor(col).desc()]


def version_key(version: str) -> tuple[int, int]:
    """The order of releases, newest greatest."""
    major, minor = version.split(".")
    return int(major), int(minor)
