"""Blocking keys: one cleaned record to many typed keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recolith import lexicon as lx


def _key(kind: str, value: Column) -> Column:
    return F.struct(F.lit(kind).alias("key_type"), value.alias("key"))


def _words_without(words: Column, generic: list[str]) -> Column:
    stop = F.array(*[F.lit(x) for x in generic])
    return F.filter(words, lambda t: ~F.array_contains(stop, t))


def _with_words(records: DataFrame) -> DataFrame:
    """Adds the words that keys are made of, each list made once for a record."""
    out = records.withColumn("__parts", F.filter(F.split("clean_address", " "), lambda t: t != ""))
    return out.withColumns({
        "__name": _words_without(F.filter(F.split("core_name", " "), lambda t: t != ""), lx.GENERIC_NAME_WORDS),
        "__joined": F.replace(F.col("core_name"), F.lit(" "), F.lit("")),
        "__digits": F.filter("__parts", lambda t: t.rlike("^[0-9]+$")),
        "__streets": _words_without(F.filter("__parts", lambda t: ~t.rlike("^[0-9]+$") & (F.length(t) >= 4)), lx.GENERIC_ADDRESS_WORDS),
    })


def _key_array() -> Column:
    """Distinct (key_type, key) structs of a record with its words."""
    core, joined, name, digits, streets = (F.col(c) for c in ("core_name", "__joined", "__name", "__digits", "__streets"))
    first = F.get(name, F.lit(0))
    postal = F.get(F.filter(digits, lambda t: F.length(t).isin(5, 6)), F.lit(0))
    none = F.array().cast("array<struct<key_type:string,key:string>>")
    one = {
        "CN": F.when(F.length(core) >= 3, core),
        "2W": F.when(F.size(name) >= 2, F.concat_ws("_", F.slice(name, 1, 2))),
        "1W": F.when(F.length(first) >= 3, first),
        "PFX4": F.when(F.length(joined) >= 4, F.left(joined, F.lit(4))),
        "PFX5": F.when(F.length(joined) >= 5, F.left(joined, F.lit(5))),
        "PIN_NAME": F.when(F.length(first) >= 3, F.concat(postal, F.lit("_"), first)),
        "ADDR2W": F.when(F.size(streets) >= 2, F.concat_ws("_", F.slice(streets, 1, 2))),
    }
    single = F.array(*[F.when(value.isNotNull(), _key(kind, value)) for kind, value in one.items()])
    crossed = F.flatten(F.transform(F.slice(digits, 1, 2), lambda n: F.transform(F.slice(streets, 1, 3), lambda w: _key("ADDR", F.concat(n, F.lit("_"), w)))))
    return F.array_distinct(F.concat(F.filter(single, lambda x: x.isNotNull()), F.coalesce(crossed, none)))


def _country() -> Column:
    return F.when(F.col("clean_country") == "", "UNK").otherwise(F.col("clean_country")).alias("country")


def blocking_keys(records: DataFrame) -> DataFrame:
    """(entity_id, country, key_type, key) of cleaned records; a blank country is UNK."""
    return _with_words(records).select("entity_id", _country(), F.explode(_key_array()).alias("k")).select("entity_id", "country", "k.key_type", "k.key")


def key_sets(records: DataFrame) -> DataFrame:
    """(entity_id, keys): the sorted distinct (country, key_type, key) of each id that has any; rows of one id are taken
    together, rows without one are left out."""
    found = _with_words(records.filter("entity_id is not null")).select("entity_id", F.struct(_country(), _key_array().alias("found")).alias("x"))
    every = found.groupBy("entity_id").agg(F.collect_list("x").alias("x"))
    one = F.flatten(F.transform("x", lambda x: F.transform(x["found"], lambda k: F.struct(x["country"].alias("country"), k["key_type"].alias("key_type"), k["key"].alias("key")))))
    return every.select("entity_id", F.sort_array(F.when(F.size("x") == 1, one).otherwise(F.array_distinct(one))).alias("keys")).filter(F.size("keys") > 0)


def weight() -> Column:
    """Weight of a key, by its type."""
    table = F.create_map(*[F.lit(x) for pair in lx.KEY_WEIGHTS.items() for x in pair])
    return F.try_element_at(table, F.col("key_type")).cast("bigint")
