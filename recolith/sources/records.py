"""Readers and writers of tab-separated record, truth and result files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
TRUTH = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "matched_entity_ids")])


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType = RECORD, columns: list[str] | None = None) -> DataFrame:
    """All columns as strings; an empty field is an empty string. A missing file gives an empty table. ``columns``
    prunes the scan."""
    if not exists(spark, path):
        df = spark.createDataFrame([], schema)
    else:
        df = spark.read.schema(schema).option("sep", "\t").option("header", True).option("escape", '"').csv(path)
    names = columns or schema.fieldNames()
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in names])


def head(df: DataFrame, n: int, key: str = "entity_id") -> DataFrame:
    """The first n rows by key; a file's own order is not kept by a distributed scan."""
    return df.orderBy(key).limit(n)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, value) of one file, from 1. A file is read in order of its splits, so ids that grow with partition
    and place give the line order; the number follows by a count of lines in earlier partitions."""
    raw = spark.read.text(path).withColumn("__id", F.monotonically_increasing_id()).withColumn("__p", F.spark_partition_id())
    counts = raw.groupBy("__p").agg(F.count("*").alias("__n"), F.min("__id").alias("__first")).collect()  # one row for each split
    before, at = [], 0
    for r in sorted(counts, key=lambda r: r["__p"]):
        before.append((r["__p"], at - r["__first"] + 1))
        at += r["__n"]
    shift = spark.createDataFrame(before, "__p int, __shift bigint")
    return raw.join(F.broadcast(shift), "__p").select((F.col("__id") + F.col("__shift")).alias("line_no"), "value")


def read_targets(spark: SparkSession, *paths: str) -> DataFrame:
    """Target files in load order, with load_seq rising from the first row of the first file."""
    out = None
    for k, path in enumerate(paths):
        df = read_tsv(spark, path).withColumn("load_seq", F.monotonically_increasing_id() + F.lit(k) * F.lit(1 << 55))
        out = df if out is None else out.unionByName(df)
    return out


def write_tsv(df: DataFrame, path: str, single: bool = False) -> None:
    """Tab-separated, unquoted, with a header; empty strings stay empty. ``single`` makes one part file."""
    out = df.coalesce(1) if single else df
    out.write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").option("quote", "").csv(path)


def publish(spark: SparkSession, folder: str, path: str) -> None:
    """Moves the only part file of a written folder to a path of its own."""
    sc = spark.sparkContext
    Path = sc._jvm.org.apache.hadoop.fs.Path
    fs = Path(folder).getFileSystem(sc._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in fs.listStatus(Path(folder)) if s.getPath().getName().startswith("part-"))
    fs.delete(Path(path), False)
    fs.rename(part, Path(path))
    fs.delete(Path(folder), True)


def in_file_order(rows: DataFrame, references: DataFrame) -> DataFrame:
    """Result rows in the order of the references' load_seq, or of their ids where there is none."""
    if "load_seq" not in references.columns:
        return rows.orderBy("source1_entity_id")
    place = references.select(F.col("entity_id").alias("source1_entity_id"), F.col("load_seq").alias("__place"))
    return rows.join(place, "source1_entity_id").orderBy("__place", "source1_entity_id").drop("__place")


def write_results(references: DataFrame, ranked: DataFrame, matched: DataFrame, folder: str) -> tuple[str, str]:
    """candidate_pairs and matching_results: one row per reference, lists by rank, or empty; in the order of the references'
    file where they have load_seq, else of their ids."""
    from recolith.operators.blocking import candidate_lists

    pairs = candidate_lists(references, ranked)
    hits = candidate_lists(references, ranked.join(matched.select("s1_id", "target_id"), ["s1_id", "target_id"], "left_semi"))
    hits = hits.withColumnRenamed("candidate_entity_ids", "matched_entity_ids")
    write_tsv(in_file_order(pairs, references), f"{folder}/candidate_pairs")
    write_tsv(in_file_order(hits, references), f"{folder}/matching_results")
    return f"{folder}/matching_results", f"{folder}/candidate_pairs"
