"""Data audit: profiles of record files, ids, ground truth and regions; each report is a small table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recolith.functions.cleaning import trim_all
from recolith.lexicon import PATTERNS
from recolith.operators.filters import is_blank, is_padded, is_whitespace_only, valid_id


def null_profile(df: DataFrame) -> DataFrame:
    """(column, n, missing, missing_pct, whitespace_only, corrupt) for each column, in one pass."""
    named = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("v")) for c in df.columns])).alias("x")
    v = F.col("x.v")
    out = df.select(named).groupBy(F.col("x.column").alias("column")).agg(
        F.count("*").alias("n"), F.count_if(is_blank(v)).alias("missing"), F.count_if(is_whitespace_only(v)).alias("whitespace_only"), F.count_if(v.rlike(PATTERNS["corrupt"])).alias("corrupt")
    )
    return out.withColumn("missing_pct", F.round(100 * F.col("missing") / F.col("n"), 3))


def length_stats(df: DataFrame, columns: tuple[str, ...] = ("business_name", "business_address")) -> DataFrame:
    """(column, shortest, mean, middle, longest, very_short, very_long) of text lengths; the median is exact."""
    named = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.length(F.coalesce(F.col(c), F.lit(""))).alias("n")) for c in columns])).alias("x")
    n = F.col("x.n")
    return df.select(named).groupBy(F.col("x.column").alias("column")).agg(
        F.min(n).cast("bigint").alias("shortest"), F.round(F.avg(n), 2).alias("mean"), F.median(n).alias("middle"), F.max(n).cast("bigint").alias("longest"),
        F.count_if(n <= 1).alias("very_short"), F.count_if(n > 150).alias("very_long"))


def id_audit(df: DataFrame, source: int, id_col: str = "entity_id") -> DataFrame:
    """One row: totals, duplicates, wrong prefix or format, padding, and the first five offenders of each, by id."""
    c = F.col(id_col)
    counts = df.groupBy(c.alias("id")).agg(F.count("*").alias("n"))
    i = F.col("id")
    wrong, odd = ~i.startswith(f"S{source}-"), ~valid_id(i, source)
    totals = counts.agg(
        F.sum("n").alias("total"), F.count("*").alias("distinct_ids"), F.sum(F.when(wrong, F.col("n")).otherwise(0)).alias("wrong_prefix"),
        F.sum(F.when(odd, F.col("n")).otherwise(0)).alias("bad_format"), F.sum(F.when(is_padded(i), F.col("n")).otherwise(0)).alias("padded"),
    )

    def first(condition, name: str) -> DataFrame:
        some = counts.filter(condition).orderBy("id").limit(5)
        return some.agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias(name))

    out = totals.withColumn("duplicates", F.col("total") - F.col("distinct_ids"))
    for condition, name in ((F.col("n") > 1, "duplicate_examples"), (wrong, "prefix_examples"), (odd, "format_examples")):
        out = out.crossJoin(F.broadcast(first(condition, name)))  # single rows
    return out


def _lists(truth: DataFrame):
    return F.filter(F.transform(F.split(F.coalesce("matched_entity_ids", F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def truth_cardinality(truth: DataFrame) -> DataFrame:
    """One row: singletons, one match, more; largest and mean list, shares. Repeats within a list count."""
    n = F.size(_lists(truth))
    out = truth.agg(
        F.count("*").alias("total"), F.count_if(n == 0).alias("singletons"), F.count_if(n == 1).alias("one_to_one"), F.count_if(n > 1).alias("one_to_many"),
        F.max(n).cast("bigint").alias("largest"), F.round(F.avg(n), 3).alias("mean_matches"))
    return out.withColumn("singleton_pct", F.round(100 * F.col("singletons") / F.col("total"), 2))


def truth_sources(truth: DataFrame) -> DataFrame:
    """One row: lists of S2 ids only, S3 only, both; self-matches and lists with repeats."""
    ids = _lists(truth)

    def any_of(prefix: str):
        return F.exists(ids, lambda x: x.startswith(prefix))

    s1, s2, s3 = any_of("S1-"), any_of("S2-"), any_of("S3-")
    return truth.agg(
        F.count_if(s2 & ~s3).alias("s2_only"), F.count_if(s3 & ~s2).alias("s3_only"), F.count_if(s2 & s3).alias("both"),
        F.count_if(s1).alias("self_matches"), F.count_if(F.size(ids) != F.size(F.array_distinct(ids))).alias("with_repeats"))


def country_counts(df: DataFrame) -> DataFrame:
    """(country, n) of raw labels, trimmed and in upper case, not made canonical."""
    return df.groupBy(F.upper(trim_all(F.coalesce("country", F.lit("")))).alias("country")).agg(F.count("*").alias("n"))


def open_set_preserved(train: DataFrame, test: DataFrame) -> DataFrame:
    """One row: whether France occurs in test but not in train files."""
    def has(df: DataFrame, name: str) -> DataFrame:
        return country_counts(df).agg((F.count_if(F.col("country").isin("FR", "FRANCE")) > 0).alias(name))

    return has(train, "a").crossJoin(has(test, "b")).select((F.col("b") & ~F.col("a")).alias("open_set_preserved"))  # single rows


def region_profile(df: DataFrame) -> DataFrame:
    """One row: records of France, and pattern counts for France, India and the US."""
    c = F.upper(trim_all(F.coalesce("country", F.lit(""))))
    fr, ind, us = c.isin("FR", "FRANCE"), c.isin("IN", "INDIA"), c.isin("US", "USA", "UNITED STATES")
    name, addr = (F.coalesce(x, F.lit("")) for x in ("business_name", "business_address"))

    def hit(text, key):
        return text.rlike(PATTERNS[key])

    return df.agg(
        F.count_if(fr).alias("france_records"), F.count_if(fr & (hit(name, "fr_accent") | hit(addr, "fr_accent"))).alias("france_accents"),
        F.count_if(fr & hit(addr, "fr_postal")).alias("france_postal"), F.count_if(fr & hit(addr, "fr_street")).alias("france_street"),
        F.count_if(fr & hit(name, "fr_legal")).alias("france_legal"), F.count_if(ind & hit(addr, "in_pin")).alias("india_pin"),
        F.count_if(ind & hit(addr, "in_landmark")).alias("india_landmark"), F.count_if(us & hit(addr, "us_zip")).alias("us_zip"))


def schema_audit(lines: DataFrame, expected: list[str]) -> DataFrame:
    """One row about raw lines (line_no, value) of a tab-separated file: header match, rows, ragged rows and the
    first five of them. Lines are read as text, as a CSV reader hides fields that are too many or too few."""
    fields = F.split(F.regexp_replace("value", r"[\r\n]+$", ""), "\t", -1)
    head = F.transform(fields, lambda x: F.trim(x))
    width = F.size(fields)
    ragged = (F.col("line_no") > 1) & (width != len(expected))
    first = lines.filter(ragged).orderBy("line_no").limit(5).agg(F.array_sort(F.collect_list(F.struct("line_no", width.alias("found")))).alias("first_ragged"))
    out = lines.agg(
        F.coalesce(F.max(F.when(F.col("line_no") == 1, head == F.array(*[F.lit(x) for x in expected]))), F.lit(False)).alias("header_ok"),
        F.coalesce(F.max(F.when(F.col("line_no") == 1, width)), F.lit(0)).cast("bigint").alias("n_columns"),
        F.count_if(F.col("line_no") > 1).alias("n_rows"), F.count_if(ragged).alias("n_ragged"))
    return out.crossJoin(F.broadcast(first))  # single rows


def audit_passed(spark: SparkSession, reports: list[DataFrame]) -> bool:
    """True if no schema or id report holds a finding."""
    bad = ("n_ragged", "duplicates", "wrong_prefix", "bad_format")
    for r in reports:
        row = r.first().asDict()
        if any(row.get(k) for k in bad) or row.get("header_ok") is False:
            return False
    return True
