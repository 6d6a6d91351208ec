"""Line dedup by winnowing over line hashes, with DataFrame functions only.

The sequence of a document is its lines that hold words. A line is deleted if it lies in a run of whole
consecutive lines that together hold at least MIN_WORDS words and that also occurs at an earlier place, places
being ordered by (id, line). Shorter repeats (a licence line, a heading) stay. Lines are compared exactly, but for
ASCII white space at their ends.

Every line starts a window, the shortest run from it of at least MIN_WORDS words, and ends one. In each window
the smallest line hash is its fingerprint, the first of equals, with its position (winnowing). A repeated run holds a whole
window, and both copies choose the same fingerprint at the same place of it, so fingerprints that occur at one position
only drop out. The positions of the others are joined to the earliest position of the same fingerprint, under equal lines
of a window around it: a match. Each matched position is extended backwards and forwards over the lines that agree, which
are those of all matched windows that chose it; runs that touch are merged and, where they are not the earliest, deleted.
Joining to the earliest position under a window's lines, not to every position of a fingerprint, keeps a line that a third of all
documents share from meeting itself.

Defined results: a place is (id, text, line), ordered by id (null first), a hash of the text, and line. Rows that share id and
text are one place and each is returned; rows that share an id only, or have none, are documents of their own. Null and
empty texts pass unchanged with n_lines 0. A text all of whose lines are deleted becomes empty. Other columns, whatever
their names, pass through ``dedup`` unchanged. An empty table gives an empty result. Only
hashes of lines are shuffled and sorted by document; a text moves once, to meet its list of deleted lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recolith.llm.runtime import Scratch

MIN_WORDS = 50
_ID, _OF, _ROW, _TEXT, _GONE = "__rl_id", "__rl_of", "__rl_row", "__rl_text", "__rl_gone"
#: What a document is: rows with the same id and text are one.
_DOC = [_ID, _OF]


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _windows(docs: DataFrame, min_words: int) -> DataFrame:
    """(id, of, lo, hi, at, mark, content) of every window; lo and hi are positions in the text's lines, ``at`` that of the
    fingerprint among those that hold words."""
    part = F.transform(
        _lines(F.col(_TEXT)),
        lambda line, k: F.struct(k.alias("pos"), F.xxhash64(F.regexp_replace(line, r"^[ \t\r\x0B\f]+|[ \t\r\x0B\f]+$", "")).alias("h"), F.size(F.split(F.trim(F.regexp_replace(line, r"[ \t\r\x0B\f]+", " ")), " ")).alias("w"), (F.length(F.regexp_replace(line, r"[ \t\r\x0B\f]+", "")) > 0).alias("any")),
    )
    rows = docs.filter(F.col(_TEXT).isNotNull()).withColumn(_ROW, F.monotonically_increasing_id())
    rows = rows.select(*_DOC, _ROW, F.posexplode(F.filter(part, lambda x: x["any"])).alias("k", "x")).select(*_DOC, _ROW, "k", "x.pos", "x.h", "x.w")
    inside = Window.partitionBy(_ROW).orderBy("pos")
    rows = rows.withColumn("before", F.sum("w").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("before", F.coalesce("before", F.lit(0).cast("bigint")))
    rows = rows.withColumn("upto", F.col("before") + F.col("w"))
    ahead = Window.partitionBy(_ROW).orderBy("before").rangeBetween(0, min_words - 1)
    behind = Window.partitionBy(_ROW).orderBy("upto").rangeBetween(1 - min_words, 0)

    def run(w) -> Column:
        return F.struct(F.min("pos").over(w).alias("lo"), F.max("pos").over(w).alias("hi"), F.sum("w").over(w).alias("words"), F.min("k").over(w).alias("k"), F.collect_list("h").over(w).alias("h"))

    both = rows.select(*_DOC, F.array(run(ahead), run(behind)).alias("x"))
    out = both.select(*_DOC, F.explode(F.array_distinct(F.filter("x", lambda x: x["words"] >= min_words))).alias("x")).select(*_DOC, "x.*")
    mark = F.array_min("h")
    return out.select(*_DOC, "lo", "hi", (F.col("k") + F.array_position("h", mark) - 1).alias("at"), mark.alias("mark"), F.xxhash64("h").alias("content"))


def deleted_lines(docs: DataFrame, scratch: Scratch, min_words: int) -> DataFrame:
    """(id, of, runs): for each document that loses lines, the first and last line of the merged runs."""
    windows = scratch.save(_windows(docs, min_words), "windows")
    position = F.struct(*_DOC, "at")
    places = windows.groupBy("mark").agg(F.min(position).alias("first"), F.max(position).alias("last"))
    shared = scratch.save(places.filter("first <> last").select("mark"), "marks")
    joined = scratch.save(windows.join(shared, "mark", "left_semi"), "joined")
    first = joined.groupBy("mark", "content").agg(F.min(position).alias("first"), F.max(position).alias("last"))
    first = scratch.save(first.filter("first <> last").select("mark", "content", "first"), "first")
    matched = joined.join(first, ["mark", "content"]).filter(position > F.col("first"))
    runs = matched.groupBy(*_DOC, "at").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))  # extended both ways
    order = Window.partitionBy(*_DOC).orderBy("lo", "hi")
    reach = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = runs.withColumn("new", F.coalesce((F.col("lo") > reach + 1).cast("int"), F.lit(1)))
    merged = apart.withColumn("run", F.sum("new").over(order)).groupBy(*_DOC, "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return merged.groupBy(*_DOC).agg(F.collect_list(F.struct("lo", "hi")).alias(_GONE))


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, counts: bool = False, drop_emptied: bool = False) -> DataFrame:
    """The rows of ``df`` with later repeated runs cut from their texts; counts adds n_lines and n_deleted;
    drop_emptied leaves out rows that lose every line that holds words."""
    scratch = Scratch(df.sparkSession)
    text, key = F.col(text_col).cast("string"), F.col(id_col)
    alone = df.groupBy(key.alias(_ID)).agg(F.count("*").alias(_ROW)).filter(F.col(_ROW) > 1).isEmpty()
    of = F.lit(0).cast("bigint") if alone else F.xxhash64(text)  # where no id is repeated, the id alone is the document
    docs = df.select(key.alias(_ID), of.alias(_OF), text.alias(_TEXT))
    gone = scratch.last(deleted_lines(docs, scratch, min_words), "gone")
    joined = df.join(gone, df[id_col].eqNullSafe(gone[_ID]) & (of == gone[_OF]), "left")
    lines = F.transform(_lines(text), lambda line, k: F.struct(line.alias("line"), k.alias("k")))
    hit = F.coalesce(F.col(_GONE), F.array().cast("array<struct<lo:int,hi:int>>"))
    kept = F.filter(lines, lambda x: ~F.exists(hit, lambda r: (r["lo"] <= x["k"]) & (x["k"] <= r["hi"])))
    kept_text = F.when(F.col(_GONE).isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(kept, lambda x: x["line"]), "\n"))
    columns = [kept_text.alias(c) if c == text_col else df[c] for c in df.columns]
    if drop_emptied:
        joined = joined.filter(F.col(_GONE).isNull() | F.exists(kept, lambda x: F.length(F.regexp_replace(x["line"], r"[ \t\r\x0B\f]+", "")) > 0))
    if not counts:
        return joined.select(*columns)
    total = F.when(F.col(text_col).isNull() | (F.col(text_col) == ""), 0).otherwise(F.size(lines))
    left = F.when(F.col(_GONE).isNull(), total).otherwise(F.size(kept))
    return joined.select(*columns, total.cast("bigint").alias("n_lines"), (total - left).cast("bigint").alias("n_deleted"))
