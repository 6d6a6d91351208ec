"""Candidate retrieval: weighted votes of shared keys, or prioritised index lookups; the best k per reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recolith.functions.cleaning import index_norm
from recolith.operators.keys import key_sets, weight

TOP_K = 25


KEY = ["country", "key_type", "key"]
#: Members of a class that are moved together when pairs of classes are written out.
CHUNK = 256
#: Keys that more classes of targets than this hold are common: classes that share only such keys are met in sets.
COMMON = 64


def hold(df: DataFrame) -> DataFrame:
    """The rows, computed now and kept for the plans that read them more than once: in the folder of checkpoints, or by
    the executors where there is none."""
    return df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else df.localCheckpoint()


def _classes(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(keys, cls, n) for each set of keys, named by its smallest id, and its members (entity_id, cls, n)."""
    sets = key_sets(records)
    classes = hold(sets.groupBy("keys").agg(F.min("entity_id").alias("cls"), F.count("*").alias("n"), F.collect_list("entity_id").alias("ids")))
    return classes.select("keys", "cls", "n"), classes.select(F.explode("ids").alias("entity_id"), "cls", "n")


def _chunks() -> Column:
    return F.ceil(F.col("n") / CHUNK).cast("int")


def _chunk_of(column: str) -> Column:
    """The chunk of a member, by hash, of as many as their number asks for."""
    return F.pmod(F.xxhash64(column), _chunks().cast("bigint")).cast("int").alias("chunk")


def _chunked(members: DataFrame) -> DataFrame:
    """(cls, chunk, ids): the members in chunks."""
    return members.select("cls", _chunk_of("entity_id"), "entity_id").groupBy("cls", "chunk").agg(F.collect_list("entity_id").alias("ids"))


def _common_sets(keyed: DataFrame, side: str) -> tuple[DataFrame, DataFrame]:
    """(set, h) for each set of common keys that a class has, named by the smallest of these classes, and (class, set)."""
    mine = keyed.filter("common").groupBy(side).agg(F.sort_array(F.collect_list(F.struct(*KEY))).alias("h"))
    sets = mine.groupBy("h").agg(F.min(side).alias(f"h{side}"))
    return sets, mine.join(sets, "h").select(side, f"h{side}")


class _Shared:
    """What classes of references (a) and of targets (b) share.

    near: (a, b, ha, hb, n, score) of the classes that share a key which is not common, with the weights of all keys they
    share; such a key is held by COMMON classes of targets at most, so these are in proportion to the classes.
    far: (ha, hb, far) of the sets of common keys of two classes that share one, with the weights of those keys. Pairs of
    classes that share common keys only have this score, and are not listed."""

    def __init__(self, a: DataFrame, b: DataFrame, max_posting: int | None):
        ka = a.select(F.col("cls").alias("a"), F.explode("keys").alias("k")).select("a", "k.*")
        kb = b.select(F.col("cls").alias("b"), "n", F.explode("keys").alias("k")).select("b", "n", "k.*")
        held = kb.groupBy(KEY).agg(F.count("*").alias("held"), F.sum("n").alias("members"))
        if max_posting:
            held = held.filter(F.col("members") <= max_posting)
        held = held.join(ka.select(*KEY).distinct(), KEY).select(*KEY, (F.col("held") > COMMON).alias("common"))
        ka, kb = hold(ka.join(held, KEY)), hold(kb.join(held, KEY))
        (sa, of_a), (sb, of_b) = _common_sets(ka, "a"), _common_sets(kb, "b")
        sa, sb, self.of_a, self.of_b = hold(sa), hold(sb), hold(of_a), hold(of_b)
        left = sa.select("ha", F.explode("h").alias("k")).select("ha", "k.*").withColumn("w", weight())
        right = sb.select("hb", F.explode("h").alias("k")).select("hb", "k.*")
        self.far = hold(left.join(right, KEY).groupBy("ha", "hb").agg(F.sum("w").alias("far")))
        rare = ka.filter("not common").select("a", *KEY, weight().alias("w")).join(kb.filter("not common").select("b", "n", *KEY), KEY)
        self.rows = rare
        found = rare.groupBy("a", "b", "n").agg(F.sum("w").alias("near")).join(self.of_a, "a", "left").join(self.of_b, "b", "left")
        self.near = found.join(self.far, ["ha", "hb"], "left").select("a", "b", "ha", "hb", "n", (F.col("near") + F.coalesce("far", F.lit(0))).alias("score"))

    def best(self, k: int) -> DataFrame:
        """(a, b, score): for each a the k best, by score and smallest b, among others. Where classes share common keys
        only, the k best of a set stand for it: each has the set's score or, near, a higher one."""
        first = Window.partitionBy("hb").orderBy("b")
        few = self.of_b.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k).drop("r")
        lead = Window.partitionBy("ha").orderBy(F.desc("far"), "b")
        lists = self.far.join(few, "hb").withColumn("r", F.row_number().over(lead)).filter(F.col("r") <= k)
        far = self.of_a.join(lists.select("ha", "b", "far"), "ha").select("a", "b", F.col("far").alias("score"))
        return self.near.select("a", "b", "score").union(far).repartition("a").groupBy("a", "b").agg(F.max("score").alias("score"))


def _shared(a: DataFrame, b: DataFrame, max_posting: int | None) -> DataFrame:
    """A row for each key, common ones left out, that a class of references and one of targets share, with its weight."""
    return _Shared(a, b, max_posting).rows


def block_scores(references: DataFrame, targets: DataFrame, max_posting: int | None = None) -> DataFrame:
    """(s1_id, target_id, score): sum of the weights of shared keys, within equal countries.

    Records with the same keys have the same scores, so scores are summed once for each pair of such classes and
    written out for their members at the end; pairs that share common keys only are summed once for each pair of sets of
    such keys. Keys of one id are a set; rows without an id are left out. ``max_posting`` drops keys that more targets than
    that hold; it is off by default, as results then differ."""
    (a, refs), (b, own) = _classes(references), _classes(targets)
    shared = _Shared(a, b, max_posting)
    near = hold(shared.near)
    left = _chunked(refs).select(F.col("cls").alias("a"), F.col("ids").alias("s1_ids"))
    right = _chunked(own).select(F.col("cls").alias("b"), "chunk", F.col("ids").alias("target_ids"))
    listed = near.withColumn("chunk", F.explode(F.sequence(F.lit(0), _chunks() - 1))).join(left, "a").join(right, ["b", "chunk"]).select("s1_ids", "target_ids", "score")
    # all targets of a set of common keys but those of the classes listed above
    members = own.select(F.col("cls").alias("b"), "entity_id").join(shared.of_b, "b")
    sizes = members.groupBy("hb").agg(F.count("*").alias("n"))
    groups = members.join(sizes, "hb").select("hb", _chunk_of("entity_id"), F.struct("b", "entity_id").alias("x")).groupBy("hb", "chunk").agg(F.collect_list("x").alias("members"))
    but = near.filter("ha is not null and hb is not null").groupBy("a", "hb").agg(F.collect_set("b").alias("but"))
    cells = shared.of_a.join(shared.far, "ha").join(sizes, "hb").join(but, ["a", "hb"], "left")
    cells = cells.withColumn("chunk", F.explode(F.sequence(F.lit(0), _chunks() - 1))).join(left, "a").join(groups, ["hb", "chunk"])
    rest = F.when(F.col("but").isNull(), F.col("members")).otherwise(F.filter("members", lambda x: ~F.array_contains("but", x["b"])))
    both = listed.union(cells.select("s1_ids", rest["entity_id"].alias("target_ids"), F.col("far").alias("score")))
    return both.select(F.explode("s1_ids").alias("s1_id"), "target_ids", "score").select("s1_id", F.explode("target_ids").alias("target_id"), "score")


def top_k(scores: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k best targets of each reference; ties go to the smaller id."""
    order = Window.partitionBy("s1_id").orderBy(F.desc("score"), "target_id")
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def ranked(references: DataFrame, targets: DataFrame, k: int = TOP_K, max_posting: int | None = None) -> DataFrame:
    """The rows of top_k(block_scores(...)), without its pairs: of each class of references the k best classes of targets,
    by score and smallest id, hold its k best targets, of each class its k smallest ids at most."""
    (a, refs), (b, own) = _classes(references), _classes(targets)
    scores = _Shared(a, b, max_posting).best(k)
    best = Window.partitionBy("a").orderBy(F.desc("score"), "b")
    classes = scores.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k).drop("n")
    first = Window.partitionBy("cls").orderBy("entity_id")
    few = own.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k).select(F.col("cls").alias("b"), F.col("entity_id").alias("target_id"))
    order = Window.partitionBy("a").orderBy(F.desc("score"), "target_id")
    lists = classes.join(few, "b").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return refs.select(F.col("entity_id").alias("s1_id"), F.col("cls").alias("a")).join(lists, "a").select("s1_id", "target_id", "score", "rank")


def candidate_lists(references: DataFrame, ranked: DataFrame) -> DataFrame:
    """(source1_entity_id, candidate_entity_ids): one row per reference, ids by rank and comma-joined, or empty."""
    lists = ranked.groupBy("s1_id").agg(F.array_sort(F.collect_list(F.struct("rank", "target_id"))).alias("l"))
    ids = F.array_join(F.transform("l", lambda x: x["target_id"]), ",")
    out = references.select(F.col("entity_id").alias("s1_id")).join(lists, "s1_id", "left")
    return out.select(F.col("s1_id").alias("source1_entity_id"), F.coalesce(ids, F.lit("")).alias("candidate_entity_ids"))


def last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the one loaded last."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def indexed(df: DataFrame, order: str = "load_seq") -> DataFrame:
    """Records in the index normaliser's form, with their load order; a repeated id keeps its last row."""
    norm = index_norm(F.col("business_name"), F.col("business_address"), F.col("country"))
    return last_wins(df.select("entity_id", order, *[c.alias(name) for name, c in norm.items()]), "entity_id", order)


def tiered_top_k(references: DataFrame, index: DataFrame, k: int = TOP_K) -> DataFrame:
    """(s1_id, target_id, tier, rank): equal core first, then prefix, then postal, each in load order and cut at k
    before duplicates go; a later tier only fills what earlier ones leave. A reference has one key in each tier and takes
    the first k targets of it, so targets are cut at k for each key before they are joined."""
    refs = references.withColumnRenamed("entity_id", "s1_id")
    tiers = []
    for tier, key in enumerate(("core", "pfx", "postal"), 1):
        a = refs.filter(F.col(key) != "").select("s1_id", "country", key)
        order = Window.partitionBy("country", key).orderBy("load_seq", "target_id")
        b = index.filter(F.col(key) != "").select(F.col("entity_id").alias("target_id"), "country", key, "load_seq")
        hits = a.join(b.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k), ["country", key])
        tiers.append(hits.select("s1_id", "target_id", "load_seq", F.lit(tier).alias("tier")))
    every = tiers[0].union(tiers[1]).union(tiers[2]).groupBy("s1_id", "target_id").agg(F.min("tier").alias("tier"), F.min("load_seq").alias("load_seq"))
    order = Window.partitionBy("s1_id").orderBy("tier", "load_seq", "target_id")
    return every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("s1_id", "target_id", "tier", "rank")
