from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from relist.functions.strings import trim_java


def array_to_set(c: Column) -> Column:
    return F.array_distinct(c)


def map_trim_set(c: Column) -> Column:
    """Trim every element; elements equal after trimming collapse."""
    return F.array_distinct(F.transform(c, trim_java))


def singleton_set(c: Column) -> Column:
    """One-element set, null for a null scalar."""
    return F.when(c.isNotNull(), F.array(c))


def append(c: Column, value: Column) -> Column:
    """Append at the end, duplicates kept; a null array counts as empty."""
    return F.when(c.isNull(), F.array(value)).otherwise(F.array_append(c, value))


def array_all_empty(c: Column) -> Column:
    """Null or without elements."""
    return F.coalesce(F.size(c), F.lit(0)) <= 0


def array_exists(c: Column, predicate: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.exists(c, predicate), F.lit(False))


def flat_map_ids(c: Column) -> Column:
    """Drop the missing ids of an id list."""
    return F.filter(c, lambda x: x.isNotNull())
