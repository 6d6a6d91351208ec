"""Quality classifier by weak labels.

Overlapping heuristic labellers vote on two questions, whether a text is poor and whether it is toxic: 1 yes, 0 no,
-1 no opinion. Expectation-maximisation over the counts of vote patterns (of all documents) estimates each
labeller's confusion in each class and the posterior of every pattern. The posteriors of a bounded sample then
train a linear scorer over hashed words and votes; it scores all documents.

One toxicity labeller votes by terms that mark toxic rows in a table of labels, where one is given: word
beginnings in at least MIN_TOXIC of its toxic texts, and RATIO times as often as in others. It votes yes if more
of them occur in a text than their rate in other texts explains.

Bounds, as parameters: LABELLED labelled rows and SAMPLE training rows are taken in order of a hash of the id, ties by
id; training ends before the row with which the sample's features would pass SAMPLE_FEATURES, which bounds its bytes.
Everything else (votes, pattern counts, scores) covers all documents.

Defined results: a null or empty text gets no vote against it, and stays. A text is rejected if a score is 0.5 or more,
a tie at 0.5 included. Scores depend on the text only: a repeated row is scored like its twin, and rows that share an id or have
none are scored each (those without one train nothing). Only id and text columns are read here. An empty table gives an
empty result, an empty or missing label table leaves that labeller without opinion. The label table's id column has the
name of the texts', or ``doc_id``. Long texts are read in pieces, whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recolith.llm.runtime import Scratch, trimmed
from recolith.llm.text import NON_ALNUM, batches_of_words, ngrams, words_of

SAMPLE = 20_000
LABELLED = 20_000
SAMPLE_FEATURES = 16_000_000
MIN_TOXIC = 8
RATIO = 4
MAX_TERMS = 200
PREFIX = 6
FEATURES = 1 << 18
EPOCHS = 60
#: Rows of the sample that a gradient is summed over at once, and features kept for votes.
STEP_ROWS = 1000
VOTE_FEATURES = 64

#: Insults, and frequent function words of four languages.
INSULTS = "idiot idiots moron morons scum loser losers clown imbecile bastard bastards asshole bitch dumbass scumbag cretin jackass".split()
SLURS = "worthless pathetic disgusting stupid trash vile filthy despicable repulsive garbage braindead retarded fucking damned".split()
FUNCTION_WORDS = (
    "the of and to in a is that it was for on are as with he be at by this had not or have from "
    "de la que el en y los del se las por un para con no una su al lo como más "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an "
    "le et les des est du une que dans qui au pour pas sur plus par ce avec"
).split()

QUALITY = ("marks", "capitals", "bangs", "repeats", "function_words", "bars")
TOXIC = ("insults", "slurs", "terms", "density")


def _hashes(words) -> np.ndarray:
    return np.unique(np.concatenate([words_of(w, NON_ALNUM)[:1] for w in words]))


_SETS = {"insults": _hashes(INSULTS), "slurs": _hashes(SLURS), "function": _hashes(FUNCTION_WORDS)}
_MARKS = np.zeros(256, bool)
_MARKS[list(b"#$%&*^~=_<>{}[]\\@+|")] = True


def _in(h: np.ndarray, some: np.ndarray) -> np.ndarray:
    at = np.searchsorted(some, h)
    at[at == len(some)] = 0
    return some[at] == h if len(some) else np.zeros(len(h), bool)


def _tail(count: int, mean: float) -> float:
    """Probability of so many or more events where ``mean`` are expected (Poisson); above 40, a bound."""
    if count > 40:
        return 0.0 if count > 3 * mean else 1.0
    return 1 - sum(math.exp(-mean) * mean**k / math.factorial(k) for k in range(count))


@dataclass(frozen=True)
class Terms:
    """Hashes of word beginnings that mark toxic texts, their rate among the words of others, and the share of toxic
    texts among the labelled ones."""

    hashes: np.ndarray
    rate: float = 0.0
    share: float | None = None

    @trimmed
    def vote(self, beginnings: np.ndarray) -> int:
        if not len(self.hashes):
            return -1
        c, mean = int(_in(beginnings, self.hashes).sum()), len(beginnings) * self.rate
        if c >= 2 and c > 3 * mean and _tail(c, mean) < 3e-4:
            return 1
        return 0 if c == 0 or _tail(c, mean) > 0.05 else -1


def votes_of(counts: np.ndarray, h: np.ndarray, beginnings: np.ndarray, terms: Terms) -> list[int]:
    """Votes, in the order of QUALITY + TOXIC, on a text with these byte counts, word and beginning hashes."""
    n, total = len(h), int(counts.sum())
    out = [-1] * len(QUALITY)
    if n:
        marks = counts[_MARKS].sum() / total
        out[0] = 1 if marks > 0.06 else 0 if marks < 0.02 else -1
        upper, lower = counts[65:91].sum(), counts[97:123].sum()
        if upper + lower >= 20:
            share = upper / (upper + lower)
            out[1] = 1 if share > 0.6 else 0 if share < 0.25 else -1
        out[2] = 1 if counts[33] / n > 0.25 and counts[33] >= 5 else -1
        if n >= 30:
            grams = ngrams(h, 4)
            again = 1 - len(np.unique(grams)) / len(grams)
            out[3] = 1 if again > 0.3 else 0 if again < 0.1 else -1
            common = _in(h, _SETS["function"]).mean()
            out[4] = 1 if common < 0.01 else 0 if common > 0.08 else -1
        out[5] = 1 if counts[124] / n > 0.2 and counts[124] >= 5 else -1
    a, b = int(_in(h, _SETS["insults"]).sum()), int(_in(h, _SETS["slurs"]).sum())
    c = terms.vote(beginnings)
    # a single adjective can be innocent, and lists of one language say nothing about texts without their words, unless there is no better judge
    calm = 0 if a + b == 0 and not len(terms.hashes) else -1
    return [*out, 1 if a else -1, 1 if b >= 2 else -1, c, 1 if a + b >= 2 and (a + b) / n > 0.01 else calm]


def _texts(batch: pa.RecordBatch):
    """(row, byte counts, word hashes, hashes of word beginnings) of each text."""
    column = batch.column(1).cast(pa.large_string()).fill_null("")
    raw = column.cast(pa.large_binary())
    for lo, hi, h, at in batches_of_words(column, NON_ALNUM, PREFIX):
        for r in range(lo, hi):
            data = np.frombuffer(raw[r].as_buffer(), np.uint8)
            own = h[:, at[r - lo] : at[r - lo + 1]]
            yield r, np.bincount(data, minlength=256), own[0], own[1]


def _word_value(features: int) -> float:
    """Value of a word's feature in a text of so many features; a vote's is 1."""
    return 1 / np.sqrt(max(1, features - len(QUALITY) - len(TOXIC)))


def _features(h: np.ndarray, votes: list[int]) -> np.ndarray:
    """Features of a text: one for each vote, then its distinct words, hashed."""
    words = np.unique((h % np.uint64(FEATURES - VOTE_FEATURES)).astype(np.int32)) + VOTE_FEATURES
    return np.concatenate([np.array([3 * k + v + 1 for k, v in enumerate(votes)], np.int32), words.astype(np.int32)])


#: Pseudo-counts of yes and no votes in class 0 and 1: labellers are made to be rarely wrong when they say yes.
PRIOR = np.array([[0.2, 100.0], [2.0, 3.0]])
#: Largest share of class 0 in which a labeller is taken to say yes (one that only ever says yes, if anything: the
#: second), least share of class 1 in which terms learnt from labels do, and the largest share of class 1.
MAX_FALSE = 0.01, 0.1
MIN_TERMS = 0.5
MAX_PRIOR = 0.2


def fit_labellers(patterns: list[tuple[tuple[int, ...], int]], names: tuple[str, ...], known: float | None = None, rounds: int = 50) -> dict[tuple[int, ...], float]:
    """Posterior of class 1 for every vote pattern, by expectation-maximisation over (pattern, count). A labeller
    without opinion says nothing about the class; how often one that never says no says yes counts over all texts.
    The share of class 1 is estimated unless labels make it known."""
    if not patterns:
        return {}
    prior = 0.1 if known is None else float(np.clip(known, 1e-4, 0.5))
    votes = np.array([p for p, _ in patterns])
    n = np.array([c for _, c in patterns], float)
    yes, no = (votes == 1).astype(float), (votes == 0).astype(float)
    only_yes = no.sum(0) == 0
    least = np.array([MIN_TERMS if name == "terms" else 1e-6 for name in names])
    most = np.where(only_yes, MAX_FALSE[1], MAX_FALSE[0])
    rate = np.repeat((PRIOR[:, :1] / PRIOR.sum(1, keepdims=True)), votes.shape[1], axis=1)  # of yes, by class and labeller
    for _ in range(rounds):
        logs = np.stack([np.log(w) + yes @ np.log(rate[c]) + no @ np.log(1 - rate[c]) for c, w in enumerate((1 - prior, prior))])
        post = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))
        if known is None:
            prior = float(np.clip((n @ post + 1) / (n.sum() + 10), 1e-4, MAX_PRIOR))
        for c, w in enumerate((n * (1 - post), n * post)):
            said = w @ yes + PRIOR[c, 0]
            heard = np.where(only_yes, w.sum(), w @ (yes + no)) + PRIOR[c].sum()
            rate[c] = np.clip(said / heard, (1e-6, least)[c], (most, 1 - 1e-6)[c])
    return {tuple(v.tolist()): float(p) for v, p in zip(votes, post, strict=True)}


def _blocks(rows: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, column, value) of STEP_ROWS rows at a time."""
    out = []
    for lo in range(0, len(rows), STEP_ROWS):
        part = rows[lo : lo + STEP_ROWS]
        cols, size = np.concatenate(part), [len(x) for x in part]
        vals = np.repeat([_word_value(n) for n in size], size)
        vals[cols < VOTE_FEATURES] = 1
        out.append((np.repeat(np.arange(len(part), dtype=np.int32), size), cols, vals))
    return out


def fit_scorer(rows: list[np.ndarray], want: np.ndarray, blocks: list | None = None) -> np.ndarray:
    """Weights of a logistic scorer over hashed features, by full-batch gradient with per-feature steps; the last
    weight is the bias. ``blocks`` are those of the rows, where they are made already."""
    blocks = _blocks(rows) if blocks is None else blocks
    present = np.unique(np.concatenate([np.zeros(0, np.int32), *(np.unique(cols) for _, cols, _ in blocks)]))
    blocks = [(row, np.searchsorted(present, cols).astype(np.int32), vals) for row, cols, vals in blocks]  # others keep weight 0
    w = np.zeros(len(present) + 1)
    seen = np.full(len(w), 1e-8)
    for _ in range(EPOCHS if rows else 0):
        grad = 1e-6 * w
        for k, (row, cols, vals) in enumerate(blocks):
            aim = want[k * STEP_ROWS : (k + 1) * STEP_ROWS]
            score = np.bincount(row, weights=w[cols] * vals, minlength=len(aim)) + w[-1]
            error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - aim) / len(rows)
            grad += np.bincount(cols, weights=error[row] * vals, minlength=len(w))
            grad[-1] += error.sum()
        seen += grad * grad
        w -= 0.3 * grad / np.sqrt(seen)
    out = np.zeros(FEATURES + 1)
    out[present], out[-1] = w[:-1], w[-1]
    return out


def toxic_terms(docs: DataFrame, labels: DataFrame | None, id_col: str = "doc_id") -> Terms:
    """Terms from at most LABELLED labelled texts."""
    if labels is None:
        return Terms(np.zeros(0, np.uint64))
    own = F.col(id_col if id_col in labels.columns else "doc_id").cast("bigint")
    some = labels.select(own.alias("id"), (F.col("toxic") > 0).alias("toxic")).filter("id is not null and toxic is not null")
    some = some.orderBy(F.xxhash64("id"), "id", "toxic").limit(LABELLED)
    rows = docs.join(F.broadcast(some), "id").select("id", "text", "toxic")

    @trimmed
    def words(batches):
        for batch in batches:
            toxic = batch.column(2).to_numpy(zero_copy_only=False)
            for r, _, _, p in _texts(batch):
                own, n = np.unique(p, return_counts=True)
                own, n = np.append(own, np.uint64(0)), np.append(n, len(p))  # a row for the text itself
                bad = np.full(len(own), bool(toxic[r]))
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(n, pa.int64()), pa.array(bad)], ["w", "n", "bad"])

    seen = rows.mapInArrow(words, "w bigint, n bigint, bad boolean").groupBy("w").agg(
        F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good"), F.coalesce(F.sum(F.when(~F.col("bad"), F.col("n"))), F.lit(0)).alias("n")
    )
    whole = seen.filter("w = 0").first()
    if whole is None or not whole.bad:
        return Terms(np.zeros(0, np.uint64))
    often = (F.col("bad") / F.lit(whole.bad)) >= RATIO * (F.col("good") + 0.5) / F.lit(max(1, whole.good))
    best = seen.filter((F.col("w") != 0) & (F.col("bad") >= MIN_TOXIC) & often).orderBy(F.desc("bad"), "w").limit(MAX_TERMS).collect()
    return Terms(np.sort(np.array([r.w for r in best], np.int64).view(np.uint64)), sum(r.n for r in best) / max(1, whole.n), whole.bad / (whole.bad + whole.good))


@dataclass(frozen=True)
class Judge:
    """What fitting gives: terms, posteriors by vote pattern, and the weights of the two scorers (1 MB each)."""

    terms: Terms
    posterior: list[dict]
    weights: list[np.ndarray]

    def of(self, counts: np.ndarray, h: np.ndarray, beginnings: np.ndarray) -> tuple:
        """(votes, p_poor, p_toxic, poor_score, toxic_score, keep) of a text."""
        votes = votes_of(counts, h, beginnings, self.terms)
        q = len(QUALITY)
        x = _features(h, votes)
        v = np.full(len(x), _word_value(len(x)))
        v[: len(votes)] = 1
        p = [self.posterior[0].get(tuple(votes[:q]), 0.0), self.posterior[1].get(tuple(votes[q:]), 0.0)]
        s = [float(1 / (1 + np.exp(-np.clip(w[x] @ v + w[-1], -30, 30)))) for w in self.weights]
        return votes, *p, *s, len(h) == 0 or max(s) < 0.5


def _inputs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))


def fit(df: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> Judge:
    """Labellers and scorers fitted to a table of texts."""
    scratch = Scratch(df.sparkSession)
    docs = _inputs(df, id_col, text_col)
    terms = toxic_terms(docs, labels, id_col)
    q = len(QUALITY)

    @trimmed
    def vote(batches):
        for batch in batches:
            votes = [votes_of(counts, h, p, terms) for _, counts, h, p in _texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(votes, pa.list_(pa.int8()))], ["id", "votes"])

    voted = scratch.save(docs.mapInArrow(vote, "id bigint, votes array<tinyint>"), "votes")
    patterns = [(tuple(r.votes), r["count"]) for r in voted.groupBy("votes").count().collect()]  # 3 ** 10 at most
    sums: list[dict] = [{}, {}]
    for votes, n in patterns:
        for k, part in enumerate((votes[:q], votes[q:])):
            sums[k][part] = sums[k].get(part, 0) + n
    posterior = [fit_labellers(sorted(s.items()), names, known) for s, names, known in zip(sums, (QUALITY, TOXIC), (None, terms.share), strict=True)]

    picked = voted.filter("id is not null").orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
    train = docs.join(F.broadcast(picked.dropDuplicates(["id"])), "id").select("id", "text", "votes")

    @trimmed
    def features(batches):
        for batch in batches:
            votes = batch.column(2).to_pylist()
            xs = [_features(h, votes[r]) for r, _, h, _ in _texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(xs, pa.list_(pa.int32()))], ["id", "votes", "x"])

    sample = scratch.save(train.mapInArrow(features, "id bigint, votes array<tinyint>, x array<int>"), "sample")
    order = sample.select("id", F.size("x").alias("n")).orderBy(F.xxhash64("id"), "id").toArrow()  # SAMPLE rows at most
    taken = order.filter(pa.array(np.cumsum(order.column("n").to_numpy().astype(np.int64)) <= SAMPLE_FEATURES)).column("id")
    if taken.num_chunks and len(taken) < order.num_rows:
        sample = sample.join(F.broadcast(df.sparkSession.createDataFrame([(x,) for x in taken.to_pylist()], "id bigint")), "id")
    table = sample.orderBy("id").toArrow()
    votes = table.column("votes").to_pylist()
    rows = [x.values.to_numpy() for x in table.column("x").combine_chunks()]
    blocks = _blocks(rows)
    weights = [fit_scorer(rows, np.array([posterior[k][tuple(v[:q] if k == 0 else v[q:])] for v in votes]), blocks) for k in (0, 1)]
    scratch.clear()
    return Judge(terms, posterior, [w.astype(np.float32) for w in weights])


def classify(df: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: id, votes, p_poor and p_toxic (by votes), poor_score and toxic_score (by the scorer), keep."""
    shared = df.sparkSession.sparkContext.broadcast(fit(df, labels, id_col, text_col))
    names = ["votes", "p_poor", "p_toxic", "poor_score", "toxic_score", "keep"]
    kinds = [pa.list_(pa.int8()), *[pa.float64()] * 4, pa.bool_()]

    @trimmed
    def score(batches):
        for batch in batches:
            rows = [shared.value.of(*x) for _, *x in _texts(batch)]
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", *names])

    schema = "id bigint, votes array<tinyint>, p_poor double, p_toxic double, poor_score double, toxic_score double, keep boolean"
    return _inputs(df, id_col, text_col).mapInArrow(score, schema).withColumnRenamed("id", id_col)


def clean(df: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, with all their columns, whose texts are kept."""
    shared = df.sparkSession.sparkContext.broadcast(fit(df, labels, id_col, text_col))
    at = df.columns.index(text_col)

    @trimmed
    def sift(batches):
        for batch in batches:
            pair = pa.RecordBatch.from_arrays([batch.column(at), batch.column(at).cast(pa.string())], ["id", "text"])
            yield batch.filter(pa.array([shared.value.of(*x)[-1] for _, *x in _texts(pair)], pa.bool_()))

    return df.mapInArrow(sift, df.schema)
