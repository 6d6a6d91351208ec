"""Every operator against a plain definition, on hand-made tables and on tables of edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recolith.llm import (
    components as cc,
    op1_query,
    op1_sentencepiece as op1,
    op2_lines as op2,
    op3_embeddings as op3,
    op4_query,
    op4_wavelet as op4,
    op5_quality as op5,
    op5_query,
    op6_query,
    op6_shard as op6,
    op7_backoff as op7,
    op8_minhash as op8,
    op9_pii as op9,
    op9_query,
    op10_winnow as op10,
)

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BPE = public_tokenizers.path("byte_bpe_50k.json")
#: A clashing name for every column an operator makes or uses inside.
CLASH = ["id", "text2", "n", "h", "size", "piece", "kept", "start", "hash", "votes", "rep", "key", "__n", "label"]


def prose(rng, n):
    words = "the of and lantern harbour quiet stone winter ledger copper river meadow signal orchard candle velvet".split()
    return " ".join(f"{rng.choice(words)}{rng.choice(['', '', rng.randint(0, 99)])}" for _ in range(n))


def corpus():
    """Ids and texts: null, empty, blank, one word, ties, exact and near copies, a shared passage, a long text."""
    rng = random.Random(7)
    base = prose(rng, 120)
    passage = prose(rng, 60)
    texts = [None, "", " \n\t ", "one", "one", base, base, base.upper(), base + " tail", base.replace("stone", "stones"), passage]
    texts += [prose(rng, rng.randint(1, 90)) for _ in range(30)]
    texts += [prose(rng, 30) + "\n" + passage + "\n" + prose(rng, 20) for _ in range(5)]
    texts += ["a b c\n" * 40, "x\n\n\ny\n", "é日本 語 " * 30, "Q\0\x0b\x0cw " * 9, "<|endoftext|> and </s> <0x41> ▁ " * 2]
    texts += ["\n".join(prose(rng, 12) for _ in range(9000))]
    return list(enumerate(texts))


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(corpus(), "doc_id bigint, text string").repartition(3)
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in CLASH])


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


TEXTS = dict(corpus())


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_op1_equals_the_library(spark, docs, empty):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows, ids = by_id(op1.digests(docs, MODEL)), by_id(op1.encode(docs, MODEL))
    back = by_id(op1.decode(op1.encode(docs, MODEL), MODEL))
    for k, text in TEXTS.items():
        want = sp.encode(text or "") + [sp.eos_id()]
        assert list(ids[k].ids) == want and rows[k].n_tokens == len(want)
        assert rows[k].ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert back[k].text == sp.decode(want)
        assert rows[k].decoded_sha256 == hashlib.sha256(sp.decode(want).encode()).hexdigest()
        data, enc = (text or "").encode(), ids[k]
        assert enc.starts[0] == 0 and enc.ends[-1] == len(data) and all(a == b for a, b in zip(enc.ends, enc.starts[1:]))
        if len(data) < 5000 and "▁" not in (text or ""):
            for i, a, b in list(zip(enc.ids, enc.starts, enc.ends))[:-1]:
                if not sp.is_byte(i):
                    assert data[a:b].decode().replace(" ", "▁") in (sp.id_to_piece(i), sp.id_to_piece(i)[1:])
    assert op1.digests(empty, MODEL).count() == 0


def double_array(table):
    """A compiled map for single-byte and two-byte keys, laid out by hand: units, then the strings."""
    units, strings, used, free = [0] * 2048, b"", {0}, [256]

    def place(node, keys, depth):
        labels = sorted({k[depth] if depth < len(k) else 0 for k in keys})
        base = free[0]
        free[0] += 256
        units[node] |= (base ^ node) << 10
        for c in labels:
            child = base ^ c
            used.add(child)
            if c == 0:
                units[node] |= 1 << 8
                units[child] = (1 << 31) | values[next(k for k in keys if len(k) == depth)]
            else:
                units[child] |= c
                place(child, [k for k in keys if len(k) > depth and k[depth] == c], depth + 1)

    values = {}
    for k, v in table.items():
        values[k.encode()] = len(strings)
        strings += v.encode() + b"\0"
    place(0, list(values), 0)
    raw = np.array(units, "<u4").tobytes()
    return len(raw).to_bytes(4, "little") + raw + strings


def test_op1_longest_prefix_through_the_map():
    m = op1.CharMap(double_array({"A": "a", "AB": "x", "B": "", "C": "cc"}))
    assert m.longest(b"ABC", 0) == (2, b"x") and m.longest(b"AC", 0) == (1, b"a")
    assert m.longest(b"B", 0) == (1, b"") and m.longest(b"z", 0) is None
    enc = op1.PieceEncoder(open(MODEL, "rb").read())
    enc.map, enc.plain, enc.squeeze = m, False, True
    text, source = enc.normalise("  ABC  Az ")
    assert text == "▁xcc▁az"
    marks = list(source)
    assert marks[3] == 2 and marks[4] == marks[5] == 4 and marks[-1] == len("  ABC  Az")


def runs_of(texts, at_least):
    """Deleted lines by definition, for small texts."""
    first, gone = {}, {}
    for k, text in sorted(texts.items()):
        rows = [(i, x.strip(" \t\r\x0b\f")) for i, x in enumerate((text or "").split("\n"))]
        rows = [(i, x, len(re.split("[ \t\r\x0b\f]+", x))) for i, x in rows if x]
        cut = set()
        for i in range(len(rows)):
            n = 0
            for j in range(i, min(len(rows), i + 80)):
                n += rows[j][2]
                if n >= at_least:
                    key = tuple(x for _, x, _ in rows[i : j + 1])
                    if first.setdefault(key, (k, i)) != (k, i):
                        cut.update(x for x, _, _ in rows[i : j + 1])
        gone[k] = cut
    return gone


def test_op2_by_definition(spark, docs, empty):
    small = docs.filter(F.coalesce(F.length("text"), F.lit(0)) < 20000)
    texts = {k: t for k, t in TEXTS.items() if len(t or "") < 20000}
    gone = runs_of(texts, op2.MIN_WORDS)
    assert sum(map(bool, gone.values())) >= 5
    rows = by_id(op2.dedup(small, counts=True))
    for k, text in texts.items():
        want = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[k])
        assert rows[k].text == want and rows[k].n_deleted == len(gone[k])
    assert op2.dedup(small).columns == small.columns
    left = by_id(op2.dedup(small, drop_emptied=True))
    assert set(left) == {k for k in texts if not gone[k] or rows[k].text.strip()}
    assert op2.dedup(empty).count() == 0 and op2.dedup(docs).count() == len(TEXTS)


def test_op2_runs_of_short_lines(spark):
    a = "\n".join(f"line {i} of it" for i in range(20))
    rows = [(1, "start\n" + a), (2, "other\n" + a + "\nend"), (3, "line 3 of it\nline 4 of it"), (3, "line 3 of it\nline 4 of it")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [r.text for r in op2.dedup(df).orderBy("doc_id").collect()]
    assert got == [rows[0][1], "other\nend", rows[2][1], rows[3][1]]


def test_op2_ids_that_are_null_or_repeated(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")

    def left(*rows):
        out = op2.dedup(spark.createDataFrame(list(rows), "doc_id bigint, text string").repartition(3), counts=True)
        return sorted(((r.doc_id, r.text, r.n_deleted) for r in out.collect()), key=str)

    assert left((None, f"{a}\n{a}"), (None, f"p\n{b}")) == [(None, a, 1), (None, f"p\n{b}", 0)]
    assert left((1, a), (1, a), (2, a)) == [(1, a, 0), (1, a, 0), (2, "", 1)]
    assert left((None, a), (1, a)) == [(1, "", 1), (None, a, 0)]
    one, two = sorted([f"{a}\n{b}", f"{b}\n{a}"], key=lambda t: spark.sql("SELECT xxhash64(:t)", {"t": t}).first()[0])
    assert left((1, one), (1, two), (2, a)) == sorted([(1, one, 0), (1, "", 2), (2, "", 1)], key=str)


def test_op3_by_definition(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 8))
    near = base[:20] + rng.normal(size=(20, 8)) * 0.03
    x = np.concatenate([base, near, near + rng.normal(size=(20, 8)) * 0.03, base[:5]]).astype(np.float32)
    rows = [(i, v.tolist(), int(i % 2)) for i, v in enumerate(x)]
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [0.0] * 8, 0), (n + 2, [float("nan")] + [1.0] * 7, 0), (n + 3, [None] + [1.0] * 7, 0), (n + 4, [1.0] * 3, 0), (n + 5, x[0].tolist(), None), (n + 6, [float("inf")] * 8, 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumn("rep", F.lit("z")).withColumn("m", F.lit(1))
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    link = (u @ u.T >= 0.98) & (np.arange(n)[:, None] % 2 == np.arange(n) % 2) & ~np.eye(n, dtype=bool)
    root = list(range(n))
    for _ in range(n):
        root = [min([root[i], *(root[j] for j in np.flatnonzero(link[i]))]) for i in range(n)]
    old = op3.BLOCK, op3.CELL, op3.TILE
    op3.BLOCK, op3.CELL, op3.TILE = 8, 8, 3
    try:
        got = {r.vec_id: r for r in op3.near_duplicates(df).collect()}
    finally:
        op3.BLOCK, op3.CELL, op3.TILE = old
    for i in range(n):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (int(link[i].sum()), root[i], root[i] == i)
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(n, n + 7))
    assert op3.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("cell", [1024, 4])
def test_op3_links_within_each_length(spark, monkeypatch, cell):
    monkeypatch.setattr(op3, "CELL", cell)
    rng = np.random.default_rng(5)
    rows = []
    for width, n in ((8, 30), (3, 12), (5, 9)):
        for v in rng.normal(size=(n, width)):
            rows += [(len(rows), v.tolist(), 0), (len(rows) + 1, (v * 2).tolist(), 0)]
    rows += [(len(rows), [*rows[0][1], 0.0], 0), (len(rows) + 1, [], 0)]
    got = {r.vec_id: r for r in op3.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()}
    x = {i: np.array(v) for i, v, _ in rows if v}
    link = {i: [j for j in x if j != i and len(x[j]) == len(x[i]) and x[i] @ x[j] >= 0.98 * np.linalg.norm(x[i]) * np.linalg.norm(x[j])] for i in x}
    root = {i: i for i in x}
    for _ in x:
        root = {i: min([root[i], *(root[j] for j in link[i])]) for i in x}
    assert len(got) == len(rows) and (got[len(rows) - 1].n_links, got[len(rows) - 1].component_id) == (0, len(rows) - 1)
    assert all((got[i].n_links, got[i].component_id) == (len(link[i]), root[i]) for i in x) and all(link[i] for i in range(102))


def test_op3_sizes_pairs_of_cells_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(op3, "CELL", 4)
    monkeypatch.setattr(op3, "MAX_CELLS", 3)
    monkeypatch.setattr(op3, "TILE", 7)
    rng = np.random.default_rng(6)
    x = np.repeat(rng.normal(size=(60, 4)), 3, axis=0) + rng.normal(size=(180, 4)) * 0.05
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    n = len(rows)
    rows += [(n, (x[0] * 1e200).tolist(), 0), (n + 1, (x[1] * 1e-200).tolist(), 0), (n + 2, (x[2] * 5e-320).tolist(), 9), (0, x[0].tolist(), 0), (None, x[0].tolist(), 0)]
    got = op3.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()
    y = np.concatenate([x, x[:2]])
    u = y / np.linalg.norm(y, axis=1, keepdims=True)
    link = (u @ u.T >= 0.98) & ~np.eye(len(y), dtype=bool)
    root = list(range(len(y)))
    for _ in y:
        root = [min([root[i], *(root[j] for j in np.flatnonzero(link[i]))]) for i in range(len(y))]
    assert len(got) == n + 4 and sum(r.vec_id == 0 for r in got) == 2
    assert all((r.n_links, r.component_id) == (link[r.vec_id].sum(), root[r.vec_id]) for r in got if r.vec_id < n + 2)


def test_op4_round_trip_and_wavelet(spark, docs, empty, tmp_path):
    import tokenizers

    t = tokenizers.Tokenizer.from_file(BPE)
    path = str(tmp_path / "w")
    op4.write(docs, path, BPE, shard_tokens=5000)
    rows, at = by_id(op4.read_documents(spark, path)), 0
    for k, text in sorted(TEXTS.items()):
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        assert list(rows[k].tokens) == ids and rows[k].start == at and rows[k].n_tokens == len(ids)
        assert rows[k].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    total = Counter(x for r in rows.values() for x in r.tokens)
    assert op4.occurrences(spark, path, 2).agg(F.sum("n")).first()[0] == total[2]
    op4.write(empty, str(tmp_path / "e"), BPE)
    assert op4.read_documents(spark, str(tmp_path / "e")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 511, 512, 1030])
def test_op4_rank_select(n):
    x = np.random.default_rng(n).integers(0, 50, n)
    w = op4.Wavelet(op4.build(np.arange(1), np.array([n]), x, 16))
    assert (w.tokens() == x).all() and all(w.access(i) == x[i] for i in range(0, n, 19))
    for v in (0, 7, 49, 60000):
        assert w.count(v) == int((x == v).sum()) and w.count(v, n // 3, n // 2) == int((x[n // 3 : n // 2] == v).sum())
        assert [w.locate(v, k) for k in range(min(3, w.count(v)))] == np.flatnonzero(x == v)[:3].tolist()
    with pytest.raises(IndexError):
        w.locate(60000, 0)


def test_op4_every_character_of_the_kept_words():
    coder = op4.ByteBpe(BPE)
    assert not coder.whole
    for c in [*range(0x260), *range(0x2000, 0x2070), 0x20AC, 0x3000, 0x180E, 0x1F600]:
        text = f"a{chr(c)}b 1{chr(c)}2 {chr(c)} {chr(c) * 2}x  {chr(c)}'s.{chr(c)},\n{chr(c)} {chr(c)}.a"
        assert coder.encode(text).tolist() == coder.full.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("c", [" ", "\t", "\n", "a", "."])
def test_op4_long_runs(c):
    coder = op4.ByteBpe(BPE)
    for text in (c * 300_000, f"x{c * 300_000}y", f"some words {c * 300_000} and more. " * 2):
        assert coder.encode(text).tolist() == coder.full.encode(text, add_special_tokens=False).ids
    assert len(coder.encode(f"x{c * 5_000_000}y")) > 1000 and max(map(len, coder.known)) <= op4.LONG


def test_op4_cuts_and_forgets(monkeypatch):
    monkeypatch.setattr(op4, "KNOWN", 20)
    monkeypatch.setattr(op4, "PART", 50)
    coder, rng = op4.ByteBpe(BPE), random.Random(8)
    for _ in range(50):
        text = prose(rng, 90).replace("stone", "stone, a.b;c <|endoftext|>!")
        assert coder.encode(text).tolist() == coder.full.encode(text, add_special_tokens=False).ids
        assert len(coder.known) <= 20 and len(coder.known.old) <= 20


def test_op4_looks_up_equal_pieces_of_a_buffer_once(monkeypatch):
    coder, asked, ids_of = op4.ByteBpe(BPE), [], op4.Known.ids_of
    monkeypatch.setattr(op4.Known, "ids_of", lambda self, pieces: asked.extend(pieces) or ids_of(self, pieces))
    text = "Seré, seré. stone,\nstone### seré' stone|\n" * 5000
    assert coder.encode(text).tolist() == coder.full.encode(text, add_special_tokens=False).ids
    assert sorted(asked) == sorted(x.encode() for x in ["Seré", " seré", ",", ".", " stone", "\n", "stone", "###", "'", " stone|"])


@pytest.mark.parametrize("part", [1, 7, 60, 1 << 22])
def test_op4_cuts_of_columns(monkeypatch, part):
    monkeypatch.setattr(op4, "PART", part)
    coder, rng = op4.ByteBpe(BPE), random.Random(part)
    parts = [*" \n\t\r\x0b\x0c\x1c\x85\xa0\u1680\u180e\u2009\u2028\u202f\u205f\u3000\u200b", *"aZ9éÑß×÷€”あ中İ'.,;:!?-_|<>#$@()", "😀", " the", " word", "'s", "<|endoftext|>"]
    texts = [None, "", *("".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(4000)), None, "the end"]
    want = [coder.full.encode(t or "", add_special_tokens=False).ids for t in texts]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(["not this", *texts], kind)
        assert [x.tolist() for x in coder.encode_all(column.slice(1))] == want
        assert [x.tolist() for x in coder.encode_all(column.slice(1001, 50))] == want[1000:1050]
    assert list(coder.encode_all(pa.array([], pa.string()))) == []


def test_op4_repeated_ids(spark, tmp_path):
    rows = [(1, "b"), (1, "a"), (1, None), (1, "a"), (0, "z"), (None, "gone")]
    op4.write(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), str(tmp_path / "w"), BPE)
    got = op4.read_documents(spark, str(tmp_path / "w")).orderBy("start").collect()
    t = op4.ByteBpe(BPE)
    assert [(r.doc_id, list(r.tokens)) for r in got] == [(k, [*t.encode(x or "").tolist(), 2]) for k, x in [(0, "z"), (1, None), (1, "a"), (1, "a"), (1, "b")]]


def test_op4_equals_the_library():
    coder, rng = op4.ByteBpe(BPE), random.Random(6)
    parts = [" ", " ", "  ", "\n", "\t", "a", "the", "'s", "'", "12", "!?", ".", ",", "é", "\xa0", "\x1c", "x1", "<|endoftext|>"]
    for _ in range(20000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert coder.encode(text).tolist() == coder.full.encode(text, add_special_tokens=False).ids, repr(text)


def quality_rows():
    rng = random.Random(1)
    clean = [prose(rng, rng.randint(20, 200)).capitalize() + "." for _ in range(200)]
    poor = [" ".join(w + "###" for w in prose(rng, 60).split()) for _ in range(20)] + ["!! ".join(prose(rng, 60).upper().split()) for _ in range(20)] + ["word again " * 60] * 10
    toxic = [f"You {rng.choice(op5.INSULTS)} " + prose(rng, 40) + f" {rng.choice(op5.SLURS)} {rng.choice(op5.INSULTS)}" for _ in range(30)]
    return clean, poor, toxic


def test_op5_finds_poor_and_toxic(spark, docs, empty):
    clean, poor, toxic = quality_rows()
    rows = [(i, t) for i, t in enumerate(clean + poor + toxic)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    keep = {r.doc_id: r.keep for r in op5.classify(df).collect()}
    good = range(len(clean))
    assert sum(not keep[i] for i in good) == 0
    assert sum(keep[i] for i in range(len(clean), len(rows))) <= 2
    kept = op5.clean(df.withColumn("votes", F.lit("x")))
    assert kept.columns == ["doc_id", "text", "votes"] and {r.doc_id for r in kept.collect()} == {k for k, v in keep.items() if v}
    labels = spark.createDataFrame([(i, 1, int(i >= len(clean) + len(poor))) for i in range(len(rows))] + [(None, None, None)], "doc_id bigint, quality int, toxic int")
    assert sum(not r.keep for r in op5.classify(df, labels).filter(F.col("doc_id") < len(clean)).collect()) == 0
    edge = by_id(op5.classify(docs, labels.limit(0)))
    assert len(edge) == len(TEXTS) and edge[0].keep and edge[1].keep and edge[2].keep
    assert op5.classify(empty).count() == 0


def test_op5_expectation_maximisation_by_definition():
    """The posteriors are those that Bayes' rule gives for a fixed point of the labellers' rates."""
    rng = np.random.default_rng(4)
    bad = rng.random(4000) < 0.12
    yes, none = np.array([0.7, 0.6, 0.8]), np.array([0.3, 0.2, 0.4])
    votes = np.where(rng.random((4000, 3)) < none, -1, np.where(bad[:, None], rng.random((4000, 3)) < yes, rng.random((4000, 3)) < 0.004).astype(int))
    patterns = sorted(Counter(map(tuple, votes.tolist())).items())
    got = op5.fit_labellers(patterns, ("a", "b", "c"), rounds=300)
    post = [got[p] for p, _ in patterns]
    n = [c for _, c in patterns]
    prior = (sum(a * b for a, b in zip(n, post)) + 1) / (sum(n) + 10)
    rate = [[], []]
    for k in range(3):
        for c, limits in ((0, (1e-6, op5.MAX_FALSE[0])), (1, (1e-6, 1 - 1e-6))):
            w = [m * (q if c else 1 - q) for m, q in zip(n, post)]
            said = sum(x for x, (p, _) in zip(w, patterns) if p[k] == 1) + op5.PRIOR[c, 0]
            heard = sum(x for x, (p, _) in zip(w, patterns) if p[k] >= 0) + op5.PRIOR[c].sum()
            rate[c].append(min(max(said / heard, limits[0]), limits[1]))
    for (p, _), q in zip(patterns, post):
        like = [1 - prior, prior]
        for c in (0, 1):
            for k, v in enumerate(p):
                like[c] *= {1: rate[c][k], 0: 1 - rate[c][k], -1: 1}[v]
        assert abs(like[1] / sum(like) - q) < 1e-6
    sure = [got[tuple(v)] for v in votes.tolist()]
    assert np.mean((np.array(sure) > 0.5) == bad) > 0.93


def test_op5_scorer_by_definition():
    """Weights of the blocked sums equal those of one pass over a dense matrix."""
    rng, size = np.random.default_rng(5), op5.FEATURES + 1
    rows = [np.concatenate([np.arange(10) * 3 + rng.integers(0, 3, 10), np.unique(rng.integers(64, 300, rng.integers(0, 40)))]).astype(np.int32) for _ in range(2300)]
    want = rng.random(2300)
    x = np.zeros((2300, 301))
    for r, cols in enumerate(rows):
        x[r, cols] = np.where(cols < op5.VOTE_FEATURES, 1, 1 / np.sqrt(max(1, len(cols) - 10)))
    x[:, 300] = 1
    w, seen = np.zeros(301), np.full(301, 1e-8)
    for _ in range(op5.EPOCHS):
        grad = 1e-6 * w + x.T @ (1 / (1 + np.exp(-(x @ w))) - want) / len(rows)
        seen += grad * grad
        w -= 0.3 * grad / np.sqrt(seen)
    got = op5.fit_scorer(rows, want)
    assert len(got) == size and np.allclose(np.append(got[:300], got[-1]), w, atol=1e-6) and not got[300:-1].any()


def test_op5_query_by_definition(spark, tmp_path):
    """Scores of the query are those of its fitted judge, text by text, over null, repeated and long texts."""
    clean, poor, toxic = quality_rows()
    rows = list(enumerate([*clean, *poor, *toxic, None, "", clean[0] * 300])) + [(0, clean[1]), (None, poor[0])]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i >= 250)) for i in range(280)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, labels = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("documents", "labels"))
    judge = op5.fit(docs, labels)
    got = Counter((r.doc_id, round(r.poor_score, 6), round(r.toxic_score, 6), r.keep) for r in op5_query.op5_weak_labels(spark, str(tmp_path)).collect())
    want = Counter()
    for k, t in rows:
        h = op5.words_of(t, op5.NON_ALNUM)
        begin = np.array([op5.words_of(w.encode()[: op5.PREFIX], op5.NON_ALNUM)[0] for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))], np.uint64)
        _, _, _, a, b, keep = judge.of(np.bincount(np.frombuffer((t or "").encode(), np.uint8), minlength=256), h, begin)
        want[(k, round(a, 6), round(b, 6), keep)] += 1
    assert got == want


def test_queries_by_definition(spark, tmp_path):
    """The thin queries of operators 1, 4 and 9 on hand-made documents."""
    import sentencepiece
    import tokenizers

    texts = {k: t for k, t in TEXTS.items() if len(t or "") < 20000}
    spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    sp, bpe, at = sentencepiece.SentencePieceProcessor(model_file=MODEL), tokenizers.Tokenizer.from_file(BPE), 0
    one, four, nine = (by_id(q(spark, str(tmp_path))) for q in (op1_query.op1_sentencepiece, op4_query.op4_wavelet_matrix, op9_query.op9_pii))
    assert len(one) == len(four) == len(nine) == len(texts)
    for k, t in sorted(texts.items()):
        ids = [*sp.encode(t or ""), sp.eos_id()]
        assert (one[k].n_tokens, one[k].ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert one[k].decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
        ids = [*bpe.encode(t or "", add_special_tokens=False).ids, 2]
        assert (four[k].start, four[k].n_tokens, four[k].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
        base = plain_pii(t)
        assert (nine[k].n_email, nine[k].n_ip, nine[k].n_card, nine[k].n_phone) == tuple(sum(x[2] == kind for x in base) for kind in op9.BASE)
        assert nine[k].base_sha256 == hashlib.sha256(op9.spell(base).encode()).hexdigest()


def test_op5_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    train, test = (labels.filter(F.xxhash64("doc_id") % 2 == k) for k in (0, 1))
    train = train.union(labels.filter(F.xxhash64("doc_id") % 2 == -1))
    rows = op5.classify(docs, train).join(test, "doc_id").select("keep", "quality", "toxic").collect()
    good = [r.keep for r in rows if r.quality == 1 and r.toxic == 0]
    bad = [r.keep for r in rows if r.quality == 0]
    assert np.mean(good) >= 0.95 and np.mean(bad) <= 0.1


def test_op6_law(spark, docs, empty):
    rng = random.Random(2)
    rows = [(i, "same text" if i % 3 == 0 else prose(rng, rng.randint(0, 50))) for i in range(900)] + [(1000, None), (1001, "")]
    for df, texts in ((spark.createDataFrame(rows, "doc_id bigint, text string"), dict(rows)), (docs, TEXTS)):
        out = op6.shard(df).collect()
        assert len(out) == len(texts)
        size, slots = Counter(), defaultdict(list)
        for r in out:
            assert r.size == len((texts[r.doc_id] or "").encode()) + 1 and 0 <= r.shard < 8
            size[r.shard] += r["size"]
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        mean, most = sum(size.values()) / 8, max(r["size"] for r in out)
        assert all(abs(sum(size[k] for k in range(j)) - mean * j) <= most + mean * op6.TOLERANCE for j in range(1, 8))
    assert op6.shard(empty).count() == 0


def test_op6_equal_texts_and_large_pieces(spark, monkeypatch):
    rng = random.Random(3)
    texts = ["hot " * 30] * 400 + [None] * 30 + [""] * 30 + [prose(rng, rng.randint(1, 30)) for _ in range(500)] * 2
    rows = [(i // 2 if i < 200 else i, t) for i, t in enumerate(texts)] + [(None, "hot " * 30)] * 40
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    plain = sorted(map(tuple, op6.shard(df).collect()), key=str)
    for limit in (("PIECE_ROWS", 25), ("PIECE_BYTES", 900)):
        with monkeypatch.context() as m:
            m.setattr(op6, *limit)
            m.setattr(op6, "OPEN", 3)
            m.setattr(op6, "PROBES", 16)
            m.setattr(op6, "MIN_PIECES", 4)
            out = op6.shard(df).collect()
        assert Counter((r.doc_id, r.text) for r in out) == Counter(rows) and len(out) == len(plain)
        at, slots, size = defaultdict(list), defaultdict(list), Counter()
        for r in out:
            slots[r.shard].append(r.slot)
            at[r.text].append((r.shard, r.slot))
            size[r.shard] += r["size"]
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        starts = np.cumsum([0, *(len(slots[k]) for k in range(8))])
        for places in at.values():  # equal texts lie side by side, over shards too
            flat = sorted(starts[a] + b for a, b in places)
            assert flat[-1] - flat[0] == len(flat) - 1
        mean, most = sum(size.values()) / 8, max(r["size"] for r in out)
        assert all(abs(sum(size[k] for k in range(j)) - mean * j) <= most + mean * op6.TOLERANCE for j in range(1, 8))


def test_op6_digests_come_from_the_shards(spark, tmp_path, monkeypatch):
    rows = [(1, "one"), (2, "é\n"), (3, None), (4, "")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.text_crc32 for r in op6_query.op6_histogram_sort(spark, str(tmp_path)).collect()}
    assert got == {k: zlib.crc32((t or "").encode()) for k, t in rows}
    monkeypatch.setattr(op6_query, "shard", lambda df, **other: op6.shard(df, **other).withColumn("text", F.lit("arrived")))
    assert {r.text_crc32 for r in op6_query.op6_histogram_sort(spark, str(tmp_path)).collect()} == {zlib.crc32(b"arrived")}


def words(text, pattern):
    return re.findall(pattern, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


@pytest.mark.parametrize("fan", [128, 3])
def test_op7_by_definition(spark, docs, empty, monkeypatch, fan):
    monkeypatch.setattr(op7, "FAN", fan)
    split = {k: words(t, r"[^\x20\x09-\x0D]+") for k, t in TEXTS.items()}
    n = Counter(tuple(w[i : i + k]) for w in split.values() for k in (1, 2, 3) for i in range(len(w) - k + 1))
    total = sum(map(len, split.values()))
    old, op7.CHUNK_WORDS = op7.CHUNK_WORDS, 500
    try:
        rows = by_id(op7.backoff_scores(docs))
    finally:
        op7.CHUNK_WORDS = old
    for k, w in split.items():
        own = Counter(tuple(w[i : i + m]) for m in (1, 2, 3) for i in range(len(w) - m + 1))
        left, want = total - len(w), 0.0
        for i in range(len(w)):
            gram = tuple(w[max(0, i - 2) : i + 1])
            factor = 1.0
            while len(gram) > 1 and n[gram] - own[gram] == 0:
                gram, factor = gram[1:], factor * 0.4
            c = n[gram] - own[gram]
            if len(gram) > 1:
                s = c / (n[gram[:-1]] - own[gram[:-1]])
            else:
                s = c / left if c else 1 / (2 * (left + 1))
            want += np.log(factor * s)
        assert rows[k].n_words == len(w) and np.isclose(rows[k].log_score, want)
    assert op7.backoff_scores(empty).count() == 0


@pytest.mark.parametrize("x", [[], [0], [5, 2**63, 2**64 - 1], list(range(0, 3000, 7))])
def test_op7_packing(x):
    h = np.array(x, np.uint64)
    assert (op7._unpack(op7._pack(h)) == h).all()
    c = np.array([1, 254, 255, 256, 2**40, 0][: max(1, len(x))])
    assert (op7._unpack_counts(op7._pack_counts(c)) == c).all()


def shingle_sets(texts):
    out = {}
    for k, t in texts.items():
        w = words(t, r"[^\x20\x09-\x0D]+")
        out[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    return out


def groups(sets):
    root = {k: k for k in sets}
    linked = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in linked:
            root[a] = root[b] = min(root[a], root[b])
    return root


def near_copies():
    """Copies with few edits each: many pairs lie just over and under the limit."""
    rng = random.Random(5)
    base = prose(rng, 90).split()
    texts = {}
    for k in range(70):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = f"edit{rng.randint(0, 10**6)}"
        texts[k] = " ".join(w)
    return texts


@pytest.mark.parametrize("case", ["corpus", "near"])
def test_op8_by_definition(spark, docs, empty, case):
    texts = {k: t for k, t in TEXTS.items() if len(t or "") < 20000} if case == "corpus" else near_copies()
    df = docs.filter(F.coalesce(F.length("text"), F.lit(0)) < 20000) if case == "corpus" else spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    sets = shingle_sets(texts)
    root, rows = groups(sets), by_id(op8.near_duplicates(df))
    for k in texts:
        assert (rows[k].n_shingles, rows[k].component_id, rows[k].kept) == (len(sets[k]), root[k], root[k] == k)
    if case == "corpus":
        assert op8.near_duplicates(empty).count() == 0
        twice = op8.near_duplicates(docs.union(docs.filter("doc_id < 12"))).count()
        assert twice == len(TEXTS) + 12


def test_op8_repeated_ids(spark):
    rng = random.Random(12)
    a, b = sorted(prose(rng, 40) for _ in range(2))
    rows = [(1, a), (1, b), (1, None), (2, a), (3, b), (3, b), (4, a), (None, b)]
    got = sorted(map(tuple, op8.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()))
    n = [len(x) for x in shingle_sets({0: a, 1: b}).values()]
    assert got == [(1, n[1], 1, True)] * 3 + [(2, n[0], 2, True)] + [(3, n[1], 1, False)] * 2 + [(4, n[0], 2, False)]


def test_op8_many_short_texts_of_a_template(spark):
    rng = random.Random(13)
    texts = {k: f"dear reader of the {rng.choice('abcdefghij')} {rng.choice('klmnopq')} page {rng.choice('rstuv')} we thank you" + " again" * (k % 3) for k in range(300)}
    sets = shingle_sets(texts)
    root = groups(sets)
    rows = by_id(op8.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")))
    assert all((rows[k].n_shingles, rows[k].component_id) == (len(sets[k]), root[k]) for k in texts)


def test_op8_set_sketch_is_a_lower_bound():
    rng = np.random.default_rng(0)
    for _ in range(50):
        x = rng.integers(0, 2**63, 200, dtype=np.uint64)
        y = np.concatenate([x[:150], rng.integers(0, 2**63, 40, dtype=np.uint64)])
        bits = int(np.bitwise_count((op8.set_parity(x) ^ op8.set_parity(y)).view(np.uint64)).sum())
        assert bits <= len(set(x.tolist()) ^ set(y.tolist()))


def test_components(spark):
    from recolith.llm.runtime import Scratch

    edges = [(i, i + 1) for i in range(40)] + [(100, 103), (103, 101), (7, 7), (200, 150)]
    got = {r.v: r.root for r in cc.components(spark.createDataFrame(edges, "a bigint, b bigint"), Scratch(spark)).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[101] == got[103] == 100 and got[200] == 150


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([ -]?[0-9])+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}


def plain_pii(text):
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {"ip": lambda: all(int(x) <= 255 for x in m.group().split(".")), "card": lambda: 12 <= len(digits) <= 19 and op9.luhn(digits), "phone": lambda: 9 <= len(digits) <= 15, "email": lambda: True}
            if fine[kind]():
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda x: (x[0], op9.BASE.index(x[2])))


def test_op9_equals_the_patterns(spark, docs, empty):
    rng = random.Random(4)
    parts = ["0", "1", "12", "255", "256", ".", ".", "-", " ", "+", "+1", "a", "@", "x@y.z", "(", ")", "4111 1111 1111 1111", "٣", "é", "mailto:", "\n"]
    for _ in range(20000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))
        assert [x for x in op9.find(text) if x[2] in op9.BASE] == plain_pii(text), text
    rows = by_id(op9.detect(docs))
    for k, text in TEXTS.items():
        assert rows[k].base_sha256 == hashlib.sha256(op9.spell(plain_pii(text)).encode()).hexdigest()
        assert rows[k].n_email == sum(x[2] == "email" for x in plain_pii(text))
    assert op9.detect(empty).count() == 0
    assert op9.find("0" * 6000 + ".1.2.3")[-1][2] == "ip"


def test_op9_added_spans(spark):
    text = "see https://bob:pw@host.org/x IBAN GB82 WEST 1234 5698 7654 32, account no: 12345678, SSN 123-45-6789"
    got = {(text[a:b], kind) for a, b, kind in op9.find(text)}
    assert {("bob:pw", "url_auth"), ("GB82 WEST 1234 5698 7654 32", "iban"), ("12345678", "account"), ("123-45-6789", "ssn")} <= got
    df = spark.createDataFrame([(1, "mail a@b.co now"), (2, None)], "doc_id bigint, text string")
    assert [r.text for r in op9.mask(df).orderBy("doc_id").collect()] == ["mail [EMAIL] now", None]


def test_op9_secrets(spark):
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    text = f'token = "{key}" and API_KEY: sk-Ab12Cd34Ef56Gh78, Bearer aaaa1111bbbb2222 password="hunter2!" a token of thanks, secret: allletterswithoutdigits passwd none'
    got = {text[a:b] for a, b, kind in op9.find(text) if kind == "secret"}
    assert got == {key, "sk-Ab12Cd34Ef56Gh78", "aaaa1111bbbb2222", "hunter2!"}
    assert len(op9.find("token=" * 200_000)) == 0 and len(op9.find("password:" * 100_000)) == 1
    row = op9.detect(spark.createDataFrame([(1, text), (2, None)], "doc_id bigint, text string")).orderBy("doc_id").collect()
    assert [r.n_spans for r in row] == [len(op9.find(text)), 0] and [x[2] for x in op9.find(text) if x[2] in op9.BASE] == []


def test_scratch_needs_a_shared_folder(spark):
    from types import SimpleNamespace

    from recolith.llm.runtime import scratch_base

    far = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_base(far)


@pytest.mark.parametrize("fill", ["k", "é"])
def test_op9_long_tokens_and_mixed_cases(fill):
    token = fill * 1000
    text = f"İ hTTps://{token}@host.org, account No 12345678, iBaN NO. GB82 WEST 1234 5698 7654 32; aCCt: Is 87654321"
    got = {(text[a:b], kind) for a, b, kind in op9.find(text)}
    assert {(token, "url_auth"), ("12345678", "account"), ("GB82 WEST 1234 5698 7654 32", "iban"), ("87654321", "account")} <= got


def test_op10_by_definition(spark, docs, empty):
    rng = random.Random(9)
    shared = TEXTS[20]
    texts = [prose(rng, 40), " ".join(words(TEXTS[5], r"\S+")[10:30]), "one", prose(rng, 25) + " " + shared, None, "", "one", "b c a"]
    items = list(enumerate(texts, 100))
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("hash", F.lit("q"))
    pattern, windows = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", defaultdict(set)
    for k, t in items:
        w = words(t, pattern)
        for i in range(max(1, len(w) - 9)):
            if w:
                windows[tuple(w[i : i + 10])].add(k)
    rows = by_id(op10.decontaminate(docs, bench))
    for k, t in TEXTS.items():
        w, hit, found = words(t, pattern), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= ids
        sha = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        assert (rows[k].n_words, rows[k].n_hit, rows[k].n_items, rows[k].items_sha256, rows[k].contaminated) == (len(w), len(hit), len(found), sha, bool(hit))
    assert sum(r.contaminated for r in rows.values()) >= 5
    assert op10.decontaminate(empty, bench).count() == 0
    assert not any(r.contaminated for r in op10.decontaminate(docs, bench.limit(0)).collect())


def test_op10_ids_of_any_kind(spark):
    rng = random.Random(10)
    a, b = prose(rng, 14), prose(rng, 14)
    items = spark.createDataFrame([("x1", a), ("x1", b), ("y", a), (None, prose(rng, 12))], "item_id string, text string")
    rows = [("d", a + " z"), ("d", a + " z"), ("d", "clean"), (None, "so " + b), (None, "clean too"), ("e", None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string").withColumn("of", F.lit(1)).withColumn("hash", F.lit(2))
    got = Counter((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in op10.decontaminate(docs, items).collect())
    assert got == Counter([("d", 15, 14, 2), ("d", 15, 14, 2), ("d", 1, 0, 0), (None, 15, 14, 1), (None, 2, 0, 0), ("e", 0, 0, 0)])
    left = op10.clean(docs, items)
    assert left.columns == docs.columns and Counter((r.doc_id, r.text) for r in left.collect()) == Counter([rows[2], rows[4], rows[5]])


def test_rows_without_ids(spark, docs):
    df = docs.union(docs.filter("doc_id = 5").withColumn("doc_id", F.lit(None).cast("bigint"))).filter(F.coalesce(F.length("text"), F.lit(0)) < 20000)
    n = df.count()
    assert op8.near_duplicates(df).count() == op7.backoff_scores(df).count() == n - 1
    assert op6.shard(df).count() == op9.detect(df).count() == op5.classify(df).count() == op2.dedup(df).count() == n
