"""Cleaning functions for names, addresses and countries: Column in, Column out, all inside the JVM."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recolith import lexicon as lx


def _lookup(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def _or_itself(table: dict[str, str]):
    return lambda token: F.coalesce(F.try_element_at(_lookup(table), token), token)


def _base_letters() -> tuple[str, str, dict[str, str]]:
    """Letters whose compatibility decomposition is one base letter, those letters, and the longer expansions of
    Latin ligatures; found by rule from the Unicode database."""
    single, base, longer = [], [], {}
    for code in range(0x80, min(sys.maxunicode, 0xFFFF)):
        char = chr(code)
        if 0xD800 <= code < 0xE000:
            continue
        plain = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if plain == char or not plain:
            continue
        if len(plain) == 1:
            single.append(char)
            base.append(plain)
        elif plain.isascii() and plain.isalpha():
            longer[char] = plain
    return "".join(single), "".join(base), longer


_SINGLE, _BASE, _LONGER = _base_letters()
_LIGATURES = {k: v for k, v in _LONGER.items() if "LIGATURE" in unicodedata.name(k, "") or "DIGRAPH" in unicodedata.name(k, "")}


def strip_accents(c: Column) -> Column:
    """Letters without their marks; ligatures are spelt out. Null gives an empty string."""
    c = F.coalesce(c, F.lit(""))
    out = F.translate(F.regexp_replace(c, r"\p{M}+", ""), _SINGLE, _BASE)
    for ligature, letters in _LIGATURES.items():
        out = F.replace(out, F.lit(ligature), F.lit(letters))
    return F.when(F.octet_length(c) == F.length(c), c).otherwise(F.regexp_replace(out, r"\p{M}+", ""))


def trim_all(c: Column) -> Column:
    """Without white space of any script at either end."""
    return F.regexp_replace(c, r"^[\s\p{Z}\x1c-\x1f\x85]+|[\s\p{Z}\x1c-\x1f\x85]+$", "")


def clean_country(c: Column) -> Column:
    """Canonical label; unknown ones pass in upper case, missing ones are empty."""
    label = F.upper(trim_all(F.coalesce(c, F.lit(""))))
    return F.coalesce(F.try_element_at(_lookup(lx.COUNTRIES), label), label)


def _tokens(c: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(c, "[^a-z0-9]+", " "), " "), lambda t: t != "")


def _replaced(c: Column, rules: list[tuple[str, str]]) -> Column:
    """All patterns replaced in their order; most texts hold none of them, which one search tells."""
    out = c
    for pattern, new in rules:
        out = F.regexp_replace(out, pattern, new)
    return F.when(c.rlike("|".join(pattern for pattern, _ in rules)), out).otherwise(c)


def _once(c: Column, f) -> Column:
    """f of a value that it reads more than once, made once."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def _without_controls(c: Column) -> Column:
    return F.regexp_replace(c, "[�\\x00-\\x1f\\x7f-\\x9f]", " ")


def _name_tokens(name: Column) -> Column:
    c = F.lower(strip_accents(name))
    c = F.replace(F.replace(c, F.lit("&"), F.lit(" and ")), F.lit("@"), F.lit(" at "))
    c = _without_controls(c)
    c = F.regexp_replace(c, r"(?<=\b[a-z])\.(?=[a-z]|\b)", "")
    c = F.regexp_replace(c, r"\bwal-mart\b", "walmart")
    c = F.regexp_replace(F.regexp_replace(c, "['’]s\\b", "s"), "['’]", "")
    return F.transform(_tokens(_once(c, lambda x: _replaced(x, lx.LEGAL_PHRASES))), _or_itself(lx.LEGAL_SUFFIXES))


def clean_name(name: Column) -> Column:
    """Canonical name, legal forms kept in their short spelling."""
    return F.array_join(_name_tokens(name), " ")


def core_of(clean: Column) -> Column:
    """A cleaned name without legal forms and trailing stopwords, or itself where nothing else is left."""
    legal = F.array(*[F.lit(x) for x in sorted(set(lx.LEGAL_SUFFIXES.values()))])
    words = F.filter(F.split(clean, " "), lambda t: (t != "") & ~F.array_contains(legal, t))
    stop = "|".join(x for x in lx.TRAILING_STOPWORDS if x.isalpha())
    core = F.ltrim(F.regexp_replace(F.concat(F.lit(" "), F.array_join(words, " ")), f"( ({stop}))+$", ""))
    return _once(core, lambda x: F.when(x == "", clean).otherwise(x))


def core_name(name: Column) -> Column:
    return core_of(clean_name(name))


def clean_address(address: Column) -> Column:
    """Canonical address: state codes, then short forms of street and unit words."""
    c = _without_controls(F.replace(F.lower(strip_accents(address)), F.lit("&"), F.lit(" and ")))
    c = _once(c, lambda x: _replaced(x, [(rf"\b{state}\b", code) for state, code in lx.STATES.items()]))
    return F.array_join(F.transform(_tokens(c), _or_itself(lx.ADDRESS_ABBREVIATIONS)), " ")


def clean_records(df: DataFrame) -> DataFrame:
    """Adds clean_name, core_name, clean_address and, where there is a country, clean_country."""
    out = df.withColumns({"clean_name": clean_name(F.col("business_name")), "clean_address": clean_address(F.col("business_address"))})
    out = out.withColumn("core_name", core_of(F.col("clean_name")))
    return out.withColumn("clean_country", clean_country(F.col("country"))) if "country" in df.columns else out


def index_norm(name: Column, address: Column, country: Column) -> dict[str, Column]:
    """Cheap form for index lookups: country, core (trailing legal forms dropped, accents not read), first four
    letters of it, and the first 5 or 6 digits that stand alone in the raw address."""
    spaced = F.regexp_replace(F.replace(F.lower(F.coalesce(name, F.lit(""))), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " ")
    core = F.ltrim(F.regexp_replace(F.concat(F.lit(" "), F.trim(spaced)), f"( ({'|'.join(lx.INDEX_LEGAL)}))+$", ""))
    joined = F.replace(core, F.lit(" "), F.lit(""))
    pfx = F.when(F.length(joined) >= 4, F.left(joined, F.lit(4))).otherwise("")
    postal = F.regexp_extract(F.coalesce(address, F.lit("")), r"(?<![0-9])[0-9]{5,6}(?![0-9])", 0)
    return {"country": clean_country(country), "core": core, "pfx": pfx, "postal": postal}
