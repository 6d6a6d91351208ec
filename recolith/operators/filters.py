"""Row predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recolith.functions.cleaning import trim_all
from recolith.lexicon import ID_PATTERN


def is_blank(c: Column) -> Column:
    return trim_all(F.coalesce(c, F.lit(""))) == ""


def is_whitespace_only(c: Column) -> Column:
    return (F.coalesce(c, F.lit("")) != "") & is_blank(c)


def is_padded(c: Column) -> Column:
    return trim_all(c) != c


def valid_id(c: Column, source: int) -> Column:
    return c.rlike(ID_PATTERN.replace("{n}", str(source)))


def is_target(c: Column) -> Column:
    return c.startswith("S2-") | c.startswith("S3-")
