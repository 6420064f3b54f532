"""Packing against the tokenizer itself, and the patterns against known optima."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vialens.llm import packing
from vialens.llm.queries import QUERIES, vocabulary

DOCS = "doc_id long, text string"
TOKENIZER = "word_bpe_49k.json"


# patterns


def used(patterns, n):
    out = np.zeros(n, np.int64)
    for pattern, times in patterns:
        out += times * pattern
    return out


@pytest.mark.parametrize("seed", range(6))
def test_patterns_use_up_the_histogram(seed):
    draw = np.random.default_rng(seed)
    count = draw.integers(0, 10 ** (seed % 5 + 1), 255) * (draw.random(255) < [0.3, 0.2, 0.1][seed % 3])
    patterns = packing.cutting_stock(count, 256)
    sizes = np.arange(1, 256)
    assert (used(patterns, 255) == count).all()
    assert all(pattern @ sizes <= 256 for pattern, _ in patterns)
    # a basic solution has a pattern a class, so rounding costs a sequence a class at most
    have = np.flatnonzero(count)
    _, often = packing.relaxed(sizes[have], count[have].astype(float), 256)
    assert max(count @ sizes / 256, count[128:].sum()) <= often.sum() + 0.1
    assert sum(n for _, n in patterns) <= often.sum() * 1.01 + len(have)


def test_relaxed_program_reaches_the_optimum():
    # sheets of 100: 45, 36, 31, 14 (a textbook case, optimum 452.25)
    size, count = np.array([14, 31, 36, 45]), np.array([211, 395, 610, 97])
    patterns, often = packing.relaxed(size, count.astype(float), 100, gap=0)
    assert often.sum() == pytest.approx(452.25, abs=0.01)
    assert (patterns.T @ often >= count - 1e-6).all()


def test_knapsack_equals_search():
    draw = np.random.default_rng(3)
    for _ in range(20):
        size = np.sort(draw.choice(np.arange(1, 12), 4, replace=False))
        value = draw.random(4)
        worth, pattern = packing._knapsack(value, size, 20)
        best = max(
            value @ [a, b, c, d]
            for a in range(21) for b in range(21) for c in range(21) for d in range(21)
            if size @ [a, b, c, d] <= 20
        )
        assert worth == pytest.approx(best) and value @ pattern == pytest.approx(worth)
        assert size @ pattern <= 20


def test_places_number_every_rank_once():
    patterns = [(np.array([2, 0, 1]), 3), (np.array([1, 0, 0]), 2)]
    places = packing._Places(patterns, 4, 4)
    assert places(0, np.arange(8)).tolist() == [0, 0, 1, 1, 2, 2, 3, 4]
    assert places(2, np.arange(3)).tolist() == [0, 1, 2]
    assert places(3, np.arange(4)).tolist() == [5, 6, 7, 8]
    assert places.n == 9


# packing


def library_ids(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary(TOKENIZER))
    return [[*library.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


def held(rows, documents, length=4096):
    """Every id lies in one piece, sequences are gapless; returns tokens and padding."""
    of_document, of_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        of_document[r.doc_id].append(r)
        of_sequence[r.sequence_id].append(r)
        assert r.length > 0
    assert set(of_document) == set(documents)
    for doc_id, pieces in of_document.items():
        want, at = documents[doc_id], 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want)
            part = np.array(want[at : at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
            at += r.length
        assert at == len(want)
    tokens = padding = 0
    for pieces in of_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
        tokens += at
        padding += 0 if at & (at - 1) == 0 else length - at
    return tokens, padding


ODD = [
    None, "", " ", "É ÀÉ 　x y", "it's I'LL <|endoftext|>a<|startoftext|> b", "a\x00b ΑΣ ΑΣ. İ",
    "é ́x a ́", "日本語 \U0001f600 12345 -- !!x", "x" * 3000 + " " + "7" * 500, "same", "same",
    "word " * 20_000,
]


@pytest.mark.parametrize("n_rows", [1, 12, 400])
def test_pieces_hold_every_id(spark, n_rows):
    draw = np.random.default_rng(n_rows)
    vocabulary_ = [f"w{i} {'long' * (i % 4)}" for i in range(300)]
    texts = [*ODD]
    while len(texts) < n_rows:
        texts.append(" ".join(draw.choice(vocabulary_, int(10 ** (draw.random() * 3)))))
    texts = texts[-n_rows:]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(3)
    rows = packing.pack(docs, vocabulary(TOKENIZER)).collect()
    documents = dict(enumerate(library_ids(texts)))
    tokens, padding = held(rows, documents)
    assert tokens == sum(map(len, documents.values()))
    if n_rows == 400:
        assert padding <= 0.01 * tokens
    for r in rows:
        want = documents[r.doc_id][r.start : r.start + r.length]
        assert np.frombuffer(r.ids, "<u4").tolist() == want


def test_other_lengths_and_whole_sequences(spark):
    texts = [f"some text number {i} " * (i % 50) for i in range(200)]
    docs = spark.createDataFrame([(i, t, 1, "a") for i, t in enumerate(texts)], "doc_id long, text string, rank int, `class` string")
    pieces = packing.pack(docs, vocabulary(TOKENIZER), length=512)
    rows = pieces.collect()
    documents = dict(enumerate(library_ids(texts)))
    _, padding = held(rows, documents, 512)
    assert padding <= 512
    whole = packing.sequences(pieces).collect()
    by_id = {r.sequence_id: r for r in whole}
    for r in rows:
        ids = np.frombuffer(by_id[r.sequence_id].ids, "<u4")
        assert ids[r.offset : r.offset + r.length].tolist() == documents[r.doc_id][r.start : r.start + r.length]
    with pytest.raises(ValueError):
        packing.pack(docs, vocabulary(TOKENIZER), length=1000)


def test_null_and_repeated_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, "c"), (1, "c"), (None, None)], DOCS)
    rows = packing.pack(docs, vocabulary(TOKENIZER), ids=False).collect()
    assert sorted((r.doc_id or 0, r.doc_tokens) for r in rows if r.start == 0) == [(0, 1), (0, 3), (1, 2), (1, 2)]
    assert sum(r.length for r in rows) == 8
    assert packing.pack(docs.limit(0), vocabulary(TOKENIZER)).collect() == []


def test_many_empty_documents_leave_no_padding(spark):
    docs = spark.range(9000).select("id", F.lit(None).cast("string").alias("text"))
    rows = packing.pack(docs.withColumnRenamed("id", "doc_id"), vocabulary(TOKENIZER), ids=False).collect()
    tokens, padding = held(rows, {i: [2] for i in range(9000)})
    assert (tokens, padding) == (9000, 0)


def test_other_rules_encode_whole_documents(spark):
    path = vocabulary("byte_bpe_50k.json")
    assert packing.ByWords(vocabulary(TOKENIZER)).by_words and not packing.ByWords(path).by_words
    from tokenizers import Tokenizer

    texts = ["two  words \n x", "", "a b"]
    documents = {i: [*Tokenizer.from_file(path).encode(t).ids, 2] for i, t in enumerate(texts)}
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    held(packing.pack(docs, path).collect(), documents)


def test_query_packs_all_documents(spark):
    d = "/root/testdata/sf0.01"
    rows = QUERIES["op11_packing"](spark, d).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    documents = dict(zip(texts, library_ids(texts.values()), strict=True))
    tokens, padding = held(rows, documents)
    assert padding <= 0.001 * tokens
    assert len(rows) <= len(texts) + 2 * tokens / 4096 + 20
