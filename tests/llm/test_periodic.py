"""Periodic runs against a plain search of every period."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from vialens.llm import periodic
from vialens.llm.queries import QUERIES

DOCS = "doc_id long, text string"


def brute_runs(words):
    n, found = len(words), {}
    for q in range(1, n // periodic.TIMES + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - a + q >= max(periodic.SHORTEST, periodic.TIMES * q):
                found.setdefault((a, i + q), q)
    return sorted((a, q, e - a) for (a, e), q in found.items())


def brute_left(words, runs):
    gone = {i for a, q, n in runs for i in range(a + q, a + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def texts_of(seed):
    draw = random.Random(seed)
    texts = [None, "", " \t ", "a", "a " * 6, "a " * 5, "a b " * 4, "a b c " * 40, "x " * 700, "a a b " * 30 + "a"]
    for _ in range(60):
        words = [draw.choice("abcdefgh") for _ in range(draw.randint(0, 60))]
        for _ in range(draw.randint(0, 3)):
            block = [draw.choice("ab" if draw.random() < 0.5 else "abcdefgh") for _ in range(draw.randint(1, 40))]
            times = draw.randint(2, 9)
            stretch = (block * times)[draw.randint(0, len(block)) :]
            at = draw.randint(0, len(words))
            words[at:at] = stretch
        texts.append(draw.choice([" ", "\n", "\t "]).join(words))
    # runs of runs, and long periods
    inner = ["a"] * 9 + ["b"]
    texts.append(" ".join((inner * 5 + ["c"]) * 6))
    block = [f"w{i}" for i in range(331)]
    texts.append("lead " + " ".join(block * 4) + " " + " ".join(block[:77]) + " end")
    texts.append(" ".join(["a"] * 4000 + ["b"] + ["a"] * 4000))
    return texts


@pytest.mark.parametrize("seed,tile", [(1, 1 << 14), (2, 64), (3, 16), (4, 300)])
def test_runs_equal_brute_force_for_any_tile(spark, seed, tile):
    texts = texts_of(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(3)
    got = periodic.periodic_runs(docs, texts=True, tile=tile).collect()
    assert len(got) == len(texts)
    for r in got:
        words = (texts[r.doc_id] or "").split()
        want = brute_runs(words)
        assert [tuple(x) for x in r.runs] == want, texts[r.doc_id][:200]
        left = " ".join(brute_left(words, want))
        assert r.n_words == len(words)
        assert r.collapsed == left
        assert r.collapsed_sha256 == hashlib.sha256(left.encode()).hexdigest()


def test_tiles_cover_every_boundary():
    for n in (0, 5, 100, 5000):
        for tile in (16, 64, 1000):
            found = periodic.tiles(n, tile)
            octaves = {k for low, high, _, _ in found for k in range(low, high)}
            assert octaves == set(range(max(1, (max(n, 4) // 4).bit_length())))
            for k in octaves:
                spans = sorted((a, b) for low, high, a, b in found if low <= k < high)
                assert spans[0][0] == 0 and spans[-1][1] == n
                assert all(nxt[0] <= now[1] - min(12 << k, n - nxt[0]) or now[1] == n for now, nxt in zip(spans, spans[1:], strict=False))


def test_only_octaves_above_the_shared_ones_get_tiles_of_their_own():
    found = periodic.tiles(100_000, 1 << 14)
    assert {(low, high) for low, high, _, _ in found} == {(0, 11)} | {(k, k + 1) for k in range(11, 15)}
    assert max(b - a for _, _, a, b in found) <= 28 << 14


def test_clashing_columns_and_repeated_rows(spark):
    text = "a b " * 10
    rows = [(1, text, 5, "k", 1.0), (1, text, 6, "k", 2.0), (None, None, 7, "l", None), (2, "z", 8, None, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int, runs string, `a.b` double")
    got = periodic.periodic_runs(docs).collect()
    assert sorted((r.doc_id or 0, r.key, r.n_words, len(r.runs)) for r in got) == [(0, 7, 0, 0), (1, 5, 20, 1), (1, 6, 20, 1), (2, 8, 1, 0)]
    assert got[0].__fields__ == ["doc_id", "key", "a.b", "n_words", "runs", "collapsed_sha256"]
    assert periodic.periodic_runs(docs.limit(0)).collect() == []


def test_very_long_document_is_dealt_out(spark):
    block = [f"w{i}" for i in range(9000)]
    words = ["x"] + block * 4 + ["y"] + ["z"] * 100
    docs = spark.createDataFrame([(1, " ".join(words))], DOCS)
    got = periodic.periodic_runs(docs, tile=1 << 12).first()
    assert [tuple(r) for r in got.runs] == [(1, 9000, 36000), (36002, 1, 100)]


def planted_words(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is None:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def report(doc_id, words):
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[2], r[0], r[1]), default=(None, None, None))
    lines = "".join(f"{a},{n},{q}\n" for a, q, n in runs)
    left = " ".join(brute_left(words, runs))
    return (
        doc_id,
        len(runs),
        *(best[0], best[2], best[1]),
        best[2] and 1000 * best[2] // best[1],
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(left.encode()).hexdigest(),
    )


def test_query_equals_brute_force(spark, tmp_path):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = spark.createDataFrame([(None, "a " * 9), (-3, None), (99999999, "")], DOCS)
    extra = extra.union(spark.range(10**6, 10**6 + 120).select("id", F.lit("b c d e f g a " * 6)))
    rows = documents.select("doc_id", "text").union(extra)
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op13_periodic_runs"](spark, str(tmp_path)).drop("n_words").collect()
    want = [report(r.doc_id, planted_words(r.doc_id, r.text)) for r in rows.collect()]
    order = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)
    assert sum(r.n_runs > 0 for r in got) > 20
