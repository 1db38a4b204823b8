"""Object keys (paths, URLs): predicates and document ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_suffix(key: Column, suffix: str) -> Column:
    """The key ends in ``suffix`` and is not a directory marker."""
    return key.endswith(suffix) & ~key.endswith("/")


def listed_after(key: Column, prefix: str = "", start_after: str = "") -> Column:
    """The keys a listing with this prefix returns after ``start_after``."""
    return key.startswith(prefix) & (key > start_after)


def base_name(key: Column) -> Column:
    return F.element_at(F.split(key, "/"), -1)


def short_id(key: Column) -> Column:
    """Base name up to its first dot (ids may collide: ``a.1.txt``, ``a.2.txt``)."""
    return F.split_part(base_name(key), F.lit("."), F.lit(1))


def document_id(key: Column) -> Column:
    """Base name without its last extension."""
    return F.regexp_replace(base_name(key), r"\.[^.]*$", "")
