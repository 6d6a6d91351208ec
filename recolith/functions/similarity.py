"""Pairwise similarity functions and the fifteen features of a candidate pair."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def flag(c: Column) -> Column:
    return F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))


def levenshtein_ratio(a: Column, b: Column) -> Column:
    """1 - distance / longer length; equal strings 1 (empty ones too), one empty 0."""
    ratio = 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))
    return F.when(a == b, F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0)).otherwise(ratio)


def jaro_winkler_value(a: str, b: str) -> float:
    """Jaro-Winkler with p = 0.1, up to 4 letters, the prefix counted at any similarity, half transpositions."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    places: dict[str, list[int]] = {}
    for j, c in enumerate(b):
        places.setdefault(c, []).append(j)
    left, taken = [], set()
    for i, c in enumerate(a):
        for j in places.get(c, ()):
            if j > i + reach:
                break
            if j >= i - reach and j not in taken:
                taken.add(j)
                left.append(c)
                break
    m = len(left)
    if not m:
        return 0.0
    moved = sum(x != b[j] for x, j in zip(left, sorted(taken), strict=True)) / 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    prefix = next((k for k in range(4) if k >= len(a) or k >= len(b) or a[k] != b[k]), 4)
    return jaro + prefix * 0.1 * (1 - jaro)


def jaro_winkler(a: Column, b: Column) -> Column:
    """Arrow batches, as no built-in has this formula; repeated pairs of a batch are computed once."""

    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        memo: dict[tuple[str, str], float] = {}
        out = []
        for pair in zip(left.fillna(""), right.fillna(""), strict=True):
            if pair not in memo:
                memo[pair] = jaro_winkler_value(*pair)
            out.append(memo[pair])
        return pd.Series(out, dtype="float64")

    return F.pandas_udf(run, "double")(a, b)


def tokens(c: Column) -> Column:
    """Distinct words of a cleaned string."""
    return F.array_distinct(F.filter(F.split(c, " "), lambda t: t != ""))


def trigrams(c: Column) -> Column:
    """Distinct runs of three characters; fewer than three give none."""
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 2, F.lit(1))), lambda i: F.substring(c, i, F.lit(3)))
    return F.when(F.length(c) >= 3, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def jaccard(s: Column, t: Column) -> Column:
    """Shared over all elements of two sets; an empty side gives 0."""
    common = F.size(F.array_intersect(s, t))
    return F.when((F.size(s) == 0) | (F.size(t) == 0), F.lit(0.0)).otherwise(common / (F.size(s) + F.size(t) - common))


def numbers(words: Column) -> Column:
    return F.filter(words, lambda t: t.rlike("^[0-9]+$"))


def postal_codes(words: Column) -> Column:
    return F.filter(words, lambda t: t.rlike("^[0-9]{5,6}$"))


def prepared(df: DataFrame) -> DataFrame:
    """Cleaned records with the sets that features need, made once for a record, not for each of its pairs."""
    name, address = tokens(F.col("core_name")), tokens(F.col("clean_address"))
    return df.withColumns({
        "name_words": name, "name_grams": trigrams(F.col("core_name")), "addr_words": address, "addr_grams": trigrams(F.col("clean_address")),
    }).withColumns({"addr_numbers": numbers(F.col("addr_words")), "addr_postals": postal_codes(F.col("addr_words"))})


def native_features(a: str = "a", b: str = "b", target: Column | None = None) -> dict[str, Column]:
    """Features of a pair of prepared records in columns a_ and b_, in their fixed order, without Jaro-Winkler."""

    def x(name: str) -> Column:
        return F.col(f"{a}_{name}")

    def y(name: str) -> Column:
        return F.col(f"{b}_{name}")

    target = y("entity_id") if target is None else target
    la, lb = F.length(x("core_name")), F.length(y("core_name"))
    both = (F.size(x("addr_postals")) > 0) & (F.size(y("addr_postals")) > 0)
    return {
        "feat_name_exact_core": flag((x("core_name") != "") & (x("core_name") == y("core_name"))),
        "feat_name_exact_clean": flag((x("clean_name") != "") & (x("clean_name") == y("clean_name"))),
        "feat_name_token_jaccard": jaccard(x("name_words"), y("name_words")),
        "feat_name_char_trigram_jaccard": jaccard(x("name_grams"), y("name_grams")),
        "feat_name_levenshtein_ratio": levenshtein_ratio(x("core_name"), y("core_name")),
        "feat_name_length_diff": F.abs(la - lb).cast("double"),
        "feat_name_length_ratio": F.when(F.greatest(la, lb) == 0, F.lit(0.0)).otherwise(F.least(la, lb) / F.greatest(la, lb, F.lit(1))),
        "feat_addr_exact_clean": flag((x("clean_address") != "") & (x("clean_address") == y("clean_address"))),
        "feat_addr_token_jaccard": jaccard(x("addr_words"), y("addr_words")),
        "feat_addr_char_trigram_jaccard": jaccard(x("addr_grams"), y("addr_grams")),
        "feat_postal_exact_match": F.when(both, flag(F.arrays_overlap(x("addr_postals"), y("addr_postals")))).otherwise(F.lit(0.5)),
        "feat_number_overlap_ratio": jaccard(x("addr_numbers"), y("addr_numbers")),
        "feat_is_s2": flag(target.startswith("S2-")),
        "feat_is_s3": flag(target.startswith("S3-")),
    }


def full_features(a: str = "a", b: str = "b") -> dict[str, Column]:
    """All fifteen, in their fixed order."""
    out = native_features(a, b)
    items = list(out.items())
    items.insert(5, ("feat_name_jaro_winkler", jaro_winkler(F.col(f"{a}_core_name"), F.col(f"{b}_core_name"))))
    return dict(items)


def rule_score(features: dict[str, Column]) -> Column:
    """Fixed score from native features, a stand-in for a trained model's probability."""
    return F.round(
        0.35 * features["feat_name_token_jaccard"] + 0.25 * features["feat_name_char_trigram_jaccard"] + 0.20 * features["feat_addr_token_jaccard"]
        + 0.10 * features["feat_postal_exact_match"] + 0.10 * features["feat_name_exact_core"], 6)
