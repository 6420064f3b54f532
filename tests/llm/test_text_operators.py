"""Token store, pieces, language model and toxicity against plain Python."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from vialens.llm import language_model, pieces, token_store, toxicity
from vialens.llm.bytewords import bounds, text_chunks
from vialens.llm.queries import QUERIES, vocabulary
from vialens.operators.scale import application_folder

ODD = [
    None,
    "",
    " ",
    "a ",
    "  a  b \n\t c",
    "▁x y",
    "日本語 \U0001f600 x",
    "a\x00b",
    "  　x y",
    "x" * 500 + " " + "y" * 200,
    "it's <|endoftext|> 12 3.4!! ñandú",
    "same text here",
    "same text here",
    "word " * 30_000,
]
SCHEMA = "doc_id long, text string, key string, ids int"


def odd_docs(spark):
    return spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(ODD)], SCHEMA)


# token store


def test_pack_round_trip():
    random_ = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        numbers = (2 ** (random_.random(n) * 32)).astype(np.uint32)
        control, data = token_store.pack(numbers)
        assert len(control) == (n + 3) // 4
        assert (token_store.unpack(control, data, n) == numbers).all()
    assert token_store.pack(np.array([255, 256, 65536, 1 << 24]))[0] == bytes([0b11100100])


def test_tokens_read_back(spark, tmp_path):
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = odd_docs(spark).union(spark.createDataFrame([(3, "a twin id", "k", 1)], SCHEMA))
    folder = token_store.write_tokens(rows, path, str(tmp_path / "tokens"))
    got = token_store.read_tokens(spark, folder).orderBy("start").collect()
    texts = sorted([*enumerate(ODD), (3, "a twin id")], key=lambda x: (x[0], x[1] or ""))
    start = 0
    for (doc_id, text), row in zip(texts, got, strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc_id, start, len(ids), crc)
        assert row.ids == ids
        start += len(ids)


def test_no_documents_make_an_empty_token_table(spark):
    none = odd_docs(spark).limit(0)
    assert token_store.token_digests(none, vocabulary("byte_bpe_50k.json")).count() == 0


# pieces


def test_piece_digests(spark):
    model = vocabulary("piece_bpe_32k.model")
    library = pieces.Pieces(model).library
    got = {r.doc_id: r for r in pieces.piece_digests(odd_docs(spark), model).collect()}
    for i, text in enumerate(ODD):
        ids = library.encode(text or "")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == sha(",".join(map(str, ids)))
        assert got[i].decoded_sha256 == sha(library.decode(ids) if ids else "")
        assert got[i].n_bytes == len((text or "").encode())
    assert pieces.piece_digests(odd_docs(spark).limit(0), model).count() == 0


def test_spans_cover_the_text_and_ids_decode(spark):
    model = vocabulary("piece_bpe_32k.model")
    encoded = pieces.encode_documents(odd_docs(spark), model)
    for row in pieces.decode_ids(encoded, model).collect():
        text = ODD[row.doc_id] or ""
        assert row.decoded == text.replace("▁", " ")
        assert row.begins[1:] == row.ends[:-1]
        assert (row.begins[:1], row.ends[-1:]) == (([0], [len(text.encode())]) if text else ([], []))


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
def test_normalisation_equals_the_library(rule):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(library.serialized_model_proto())
    mine = pieces.Normaliser(proto.normalizer_spec, False, [])
    for text in ["ﬁ ① Ａ é é ｶﾞ", "  a  b ", "㌔ ㍿x", "", "Ⅷ İ ß", " x​ y", "한국어 가", *filter(None, ODD[:-1])]:
        normal, source = mine(text.encode())
        want, offsets = library.normalize(text, with_offsets=True)
        assert normal.decode() == want
        at = bounds(np.array([len(c.encode()) for c in want], np.int64))
        in_bytes = bounds(np.array([len(c.encode()) for c in text], np.int64))
        assert source[at].tolist() == in_bytes[offsets].tolist()


def test_units_equal_whole_documents():
    encoder = pieces.Pieces(vocabulary("piece_bpe_32k.model"))
    assert encoder.by_units
    texts = [t for t in ODD if t and len(t) < 1000]
    for chunk in text_chunks(pa.array(texts)):
        ids, counts, begins, ends = encoder.encode(chunk)
        at = bounds(counts)
        for i in range(chunk.n):
            part = slice(at[i], at[i + 1])
            for got, want in zip((ids, begins, ends), encoder.encode_one(chunk.text(i)), strict=True):
                assert got[part].tolist() == want.tolist()


# language model


def _brute_force(training, order):
    """log10 probability of a token list under the model, by its definition."""
    grams = [Counter() for _ in range(order + 1)]
    for tokens in training:
        padded = ["<s>"] * (order - 1) + tokens
        for i in range(order - 1, len(padded)):
            grams[order][tuple(padded[i - order + 1 : i + 1])] += 1
    for n in range(order - 1, 0, -1):
        for g in grams[n + 1]:
            grams[n][g[1:]] += 1
    discount, total, kinds = [None], [None], [None]
    for n in range(1, order + 1):
        times = Counter(grams[n].values())
        n1, n2, n3, n4 = (times[i] for i in (1, 2, 3, 4))
        if min(n1, n2, n3):
            y = n1 / (n1 + 2 * n2)
            found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
            discount.append([0, *(min(max(d, 0), i + 1) for i, d in enumerate(found))])
        else:
            discount.append([0, 0.75, 0.75, 0.75])
        total.append(Counter())
        kinds.append(defaultdict(lambda: [0, 0, 0, 0]))
        for g, c in grams[n].items():
            total[n][g[:-1]] += c
            kinds[n][g[:-1]][min(c, 3)] += 1
    types = len(grams[1])

    def probability(g):
        n = len(g)
        if n == 0:
            return 1 / (types + 1)
        context = g[:-1]
        if not total[n][context]:
            return probability(g[1:])
        d, c = discount[n], grams[n].get(g, 0)
        spare = sum(d[i] * kinds[n][context][i] for i in (1, 2, 3))
        return (max(c - d[min(c, 3)], 0) + spare * probability(g[1:])) / total[n][context]

    def score(tokens):
        padded = ["<s>"] * (order - 1) + tokens
        ends = range(order - 1, len(padded))
        return sum(math.log10(probability(tuple(padded[i - order + 1 : i + 1]))) for i in ends)

    return score


@pytest.mark.parametrize("order", [2, 3])
def test_kneser_ney_equals_its_definition(spark, order):
    draw = random.Random(order)
    texts = [" ".join(draw.choices("A b c d e f g h".split(), [9, 7, 5, 4, 3, 2, 1, 1], k=draw.randint(0, 30))) for _ in range(60)]
    texts += [None, "", "new words b A", texts[0]]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tokens = [[*(t or "").lower().split(), "</s>"] for t in texts]
    training = [t for i, t in enumerate(tokens) if zlib.crc32(str(i).encode()) % 10]
    score, counts = _brute_force(training, order), Counter(w for t in training for w in t)
    n = sum(counts.values())
    for row in language_model.perplexities(rows, order).collect():
        mine = tokens[row.doc_id]
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 10 == 0)
        assert (row.n_tokens, row.train_tokens) == (len(mine), n)
        assert row.n_known == sum(w in counts for w in mine)
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (len(counts) + 1))) for w in mine)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert row.score == pytest.approx(score(mine), rel=1e-9)


def test_the_query_is_a_trigram_model(spark, tmp_path):
    texts = ["a b c", "a b c", "x b d", "x b d", "x b d e", "y b c a", "b c", "a b d"] * 3
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    tokens = [[*t.split(), "</s>"] for t in texts]
    score = _brute_force([t for i, t in enumerate(tokens) if zlib.crc32(str(i).encode()) % 10], 3)
    got = {r.doc_id: r.score for r in QUERIES["op3_language_model"](spark, str(tmp_path)).collect()}
    assert got == pytest.approx({i: score(t) for i, t in enumerate(tokens)}, rel=1e-9)


def test_language_model_of_nothing(spark):
    rows = odd_docs(spark)
    assert language_model.perplexities(rows.limit(0)).count() == 0
    folder = language_model.fit(rows.limit(0))
    got = language_model.score_documents(rows, folder).collect()
    assert len(got) == len(ODD)
    assert {r.score for r in got} == {0.0}


def test_big_counts_are_kept(spark):
    rows = spark.createDataFrame([(1, "a b " * 400)], "doc_id long, text string")
    folder = language_model.fit(rows)
    model = language_model.Model(folder)
    assert model.train_tokens == 801
    (row,) = language_model.score_documents(rows, folder).collect()
    assert row.n_known == 801
    assert row.base_score == pytest.approx(800 * math.log10(400.1 / 801.4) + math.log10(1.1 / 801.4))


def _files(folder):
    return {os.path.join(at, name) for at, _, names in os.walk(folder) for name in names}


def test_the_model_takes_few_bytes(spark):
    draw = random.Random(8)
    texts = [" ".join(f"w{int(draw.paretovariate(0.5)) % 9000}" for _ in range(400)) for _ in range(200)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    shared = application_folder(spark).removeprefix("file:")
    before = _files(shared)
    language_model.fit(rows)
    new = _files(shared) - before
    # the n-grams are written once, as the model; no level is written as a table as well
    assert {os.path.splitext(f)[1] for f in new} == {".arrow"}
    assert sum(os.path.getsize(f) for f in new) < 16 * 200 * 401


def test_long_runs_of_next_words_and_many_contexts(spark):
    draw = random.Random(5)
    texts = [" ".join(f"w{int(draw.paretovariate(0.6)) % 700}" for _ in range(40)) for _ in range(150)]
    texts += [f"w1 w2 n{i}" for i in range(600)] + ["w1 w2 n7"] * 300
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tokens = [[*t.split(), "</s>"] for t in texts]
    score = _brute_force([t for i, t in enumerate(tokens) if zlib.crc32(str(i).encode()) % 10], 4)
    got = {r.doc_id: r.score for r in language_model.perplexities(rows, 4).collect()}
    assert got == pytest.approx({i: score(t) for i, t in enumerate(tokens)}, rel=1e-9)


def test_ngrams_are_packed_and_counted():
    random_ = np.random.default_rng(3)
    for top in (2, 1000, 2**32 - 2):
        drawn = [random_.integers(0, top, 5000).astype(np.uint32) // np.uint32(9) for _ in range(3)]
        columns, counts = language_model._counted(drawn)
        want = sorted(Counter(zip(*(c.tolist() for c in drawn), strict=True)).items())
        assert list(zip(*(c.tolist() for c in columns), strict=True)) == [g for g, _ in want]
        assert counts.tolist() == [n for _, n in want]
        back, n = language_model._decoded(language_model._encoded(columns, counts), len(counts), 3)
        assert [c.tolist() for c in back] == [c.tolist() for c in columns]
        assert n.tolist() == counts.tolist()


def test_packed_ngrams_are_small():
    random_ = np.random.default_rng(4)
    drawn = [(2 ** (random_.random(50_000) * 20)).astype(np.uint32) for _ in range(3)]
    rows = language_model._rows(*language_model._counted(drawn), 4)
    assert sum(len(r["grams"]) for r in rows) < 7 * 50_000


def test_model_needs_a_mounted_folder():
    assert language_model._mounted("file:///x/y") == "/x/y"
    with pytest.raises(ValueError):
        language_model._mounted("hdfs://host/x")


# toxicity


def _labelled(n, seed):
    draw = random.Random(seed)
    syllables = "ka lo mi re tu sa ne po vi da".split()
    word = lambda: "".join(draw.choices(syllables, k=draw.randint(1, 4)))
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        words = [word() for _ in range(draw.randint(5, 60))]
        if toxic:
            for _ in range(3):
                words[draw.randrange(len(words))] = draw.choice(["zgrumpf", "blexhorn"]) + draw.choice(["", "s", "ing", "ed"])
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxicity_on_held_out_rows_and_misspellings(spark):
    rows = _labelled(800, 3)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows], "doc_id long, toxic int, quality int")
    got = {r.doc_id: r for r in toxicity.toxicity_scores(docs, labels).collect()}
    truth = {i: y for i, _, y in rows}
    held = [r for r in got.values() if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())

    model = toxicity.train(docs, labels)
    odd = pa.array(["ka lo zgrumpfers mi re", "ka lo mi re tu", "", None, "KA LO ZGRUMPF MI"])
    scores = toxicity.score_texts(odd, model)
    assert scores[0] > 0.3  # an ending never seen
    assert scores[1] < 0.1
    assert scores[2] == scores[3] < 0.5
    assert scores[4] > 0.5
    long = toxicity.score_texts(pa.array(["ka lo mi re tu " * 20_000 + "zgrumpf blexhorn zgrumpf blexhorn"]), model)
    assert long[0] > 0.5


def test_toxicity_without_labels_or_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.toxicity_scores(docs, labels).count() == len(ODD)
    assert toxicity.toxicity_scores(docs.limit(0), labels).count() == 0
