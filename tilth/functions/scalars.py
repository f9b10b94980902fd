"""Scalar functions on text columns: lists, dates, paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_csv(c: Column) -> Column:
    """Items between commas, trimmed, without blanks; null gives an empty array."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def parse_int_csv(c: Column) -> Column:
    """As integers; a bad item is an error."""
    return F.transform(parse_csv(c), lambda x: x.cast("int"))


def parse_date(c: Column) -> Column:
    """A date in the form yyyy-MM-dd; any other form is an error."""
    return F.when(c.isNull(), F.lit(None).cast("date")).otherwise(F.when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.to_date(c, "yyyy-MM-dd")).otherwise(F.raise_error(F.concat(F.lit("not a date: "), c)).cast("date")))


def stem(path: Column) -> Column:
    """The file name without directories and without its last suffix."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def tile_of(path: Column) -> Column:
    """The stem with every ``.simp`` removed."""
    return F.replace(stem(path), F.lit(".simp"), F.lit(""))


def formats(c: Column) -> Column:
    """The requested formats: trimmed, lower-case, distinct."""
    return F.array_distinct(F.transform(parse_csv(c), lambda x: F.lower(x)))


def base_name(source: Column, layer: Column) -> Column:
    """``stem`` or ``stem_layer``."""
    return F.concat_ws("_", stem(source), F.when(layer != "", layer))


def relative_to(path: Column, root: str) -> Column:
    return F.when(F.startswith(path, F.lit(root + "/")), F.substring(path, len(root) + 2, 1 << 30)).otherwise(path)
