"""Every stage of the corpus pipeline against plain Python, and the whole of it."""

import hashlib
import os
import random
import re
import zlib

import pytest
from test_matching_operators import _component_ids, _without_repeats
from test_text_operators import _labelled

import __spark_entry__ as contract
import corpus_pipeline
from vialens.llm.pieces import Pieces
from vialens.llm.queries import vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STAGES = dict(corpus_pipeline.STAGES)


def _words(draw, n):
    return [f"w{draw.randrange(5000)}" for _ in range(n)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    draw = random.Random(11)
    passage = _words(draw, 60)
    items = [" ".join(_words(draw, 30)) for _ in range(4)]
    labelled = _labelled(800, 3)
    texts = [t for _, t, _ in labelled]
    labels = [(i, 1, y) for i, _, y in labelled]
    long = next(t for t in texts if len(t.split()) > 50)
    texts += [texts[1], long + " more", texts[3]]
    texts += [" ".join(_words(draw, 90) + passage + _words(draw, 90)) for _ in range(3)]
    texts += [" ".join(_words(draw, 60) + items[k].upper().split() + _words(draw, 60)) for k in (0, 2)]
    texts += [None, "", "  "]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    folder = tmp_path_factory.mktemp("sf")
    for name, data, schema in (
        ("documents", rows, SCHEMA),
        ("labels", labels, "doc_id long, quality int, toxic int"),
        ("benchmark", list(enumerate(items)), "item_id long, text string"),
    ):
        spark.createDataFrame(data, schema).write.parquet(os.path.join(folder, f"{name}.parquet"))
    return str(folder), rows, items, labels


def _docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_stages_are_the_stated_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "repeated_passages", "decontamination", "sentencepiece",
    ]
    assert contract.queries()["pipeline"] is corpus_pipeline.run


def test_toxic_documents_go(spark, corpus):
    folder, rows, _, labels = corpus
    kept = STAGES["toxicity"](spark, _docs(spark, rows), folder)
    assert kept.columns == COLUMNS
    ids = {r.doc_id for r in kept.collect()}
    unseen = [(i, y) for i, _, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((i not in ids) == y for i, y in unseen) / len(unseen) > 0.9
    assert {r[0] for r in rows[-3:]} <= ids


def test_one_document_of_each_group_stays(spark, corpus):
    folder, rows, *_ = corpus
    kept = STAGES["near_duplicates"](spark, _docs(spark, rows), folder)
    want = [i for i, (_, c) in enumerate(_component_ids([r[1] for r in rows], 5, 75)) if c == i]
    assert kept.columns == COLUMNS
    assert sorted(r.doc_id for r in kept.collect()) == want
    assert len(want) == len(rows) - 3


def test_repeated_passages_go(spark, corpus):
    folder, rows, *_ = corpus
    kept = STAGES["repeated_passages"](spark, _docs(spark, rows), folder).collect()
    want = _without_repeats([r[1] for r in rows], 35)
    for r in kept:
        text = rows[r.doc_id][1] or ""
        assert r.text == (text if len(text.split()) == len(want[r.doc_id]) else " ".join(want[r.doc_id]))
        assert r.n_chars == len(r.text)


def test_contaminated_documents_go(spark, corpus):
    folder, rows, items, _ = corpus
    grams = lambda t: {tuple(w[i : i + 5]) for w in [re.findall(r"\w+", (t or "").lower())] for i in range(len(w) - 4)}
    want = [i for i, t, *_ in rows if all(len(grams(t) & grams(x)) < 0.75 * len(grams(x)) for x in items)]
    kept = STAGES["decontamination"](spark, _docs(spark, rows), folder)
    assert sorted(r.doc_id for r in kept.collect()) == want
    assert len(want) == len(rows) - 2


def test_documents_with_a_short_item_go(spark, tmp_path):
    spark.createDataFrame([(1, "w1 w2 w3")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(["a b c w1 W2 w3 d e f", "a b c w1 w2 d w3 e f"])]
    kept = STAGES["decontamination"](spark, _docs(spark, rows), str(tmp_path))
    assert [r.doc_id for r in kept.collect()] == [1]


def test_whole_pipeline(spark, corpus):
    folder, rows, *_ = corpus
    docs = _docs(spark, rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == COLUMNS
    library = Pieces(vocabulary("piece_bpe_32k.model")).library
    want = {r.doc_id: library.encode(r.text or "") for r in docs.collect()}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert {i: r.ids for i, r in got.items()} == want
    assert all(r.n_tokens == len(r.ids) for r in got.values())


def test_encoding_keeps_spans_and_decodes(spark, corpus):
    folder, rows, *_ = corpus
    texts = {r[0]: r[1] or "" for r in rows}
    library = Pieces(vocabulary("piece_bpe_32k.model")).library
    for r in STAGES["sentencepiece"](spark, _docs(spark, rows), folder).collect():
        assert len(r.begins) == len(r.ends) == r.n_tokens
        assert [0, *r.ends] == [*r.begins, len(texts[r.doc_id].encode())]
        decoded = library.decode(r.ids) if r.ids else ""
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_empty_documents_table(spark, corpus):
    folder, rows, *_ = corpus
    docs = _docs(spark, rows).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0
