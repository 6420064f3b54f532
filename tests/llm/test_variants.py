"""Spelling variants against a comparison of all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vialens.llm import variants
from vialens.llm.bytewords import LOWER, text_chunks
from vialens.llm.queries import QUERIES

DOCS = "doc_id long, text string"


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(counts, ratio=10):
    near = {w: [v for v in counts if is_near(w, v)] for w in counts}
    forms = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= ratio * counts[w]:
            forms[w] = best
    out = []
    for w, n in counts.items():
        root = w
        while root in forms:
            root = forms[root]
        out.append((w, forms.get(w), root, n, len(near[w]), counts.get(forms.get(w))))
    return sorted(out)


def grouped(spark, counts, ratio=10):
    rows = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    return sorted(map(tuple, variants.variant_groups(rows, ratio).collect()))


@pytest.mark.parametrize("seed,letters,longest", [(1, "ab", 7), (2, "abé", 5), (3, "abcdefÿ", 4), (4, "a", 40)])
def test_groups_equal_brute_force(spark, seed, letters, longest):
    draw = random.Random(seed)
    words = {"".join(draw.choice(letters) for _ in range(draw.randint(1, longest))) for _ in range(300)}
    counts = {w: 10 ** draw.randint(0, 4) * draw.randint(1, 3) for w in words}
    assert grouped(spark, counts) == brute_groups(counts)


def test_long_words_beyond_the_bounds(spark):
    base = "prefixes" * 12
    words = {base + "x" * i for i in range(20)} | {base[:50] + "q" + base[50:], base[1:], "z" + base, base * 40, base * 40 + "a"}
    words |= {base[:i] + "y" + base[i + 1 :] for i in range(0, 96, 5)}
    counts = {w: 3 ** (i % 9) for i, w in enumerate(sorted(words))}
    assert grouped(spark, counts, 3) == brute_groups(counts, 3)


def test_chain_of_forms_and_ties(spark):
    counts = {"abcdefg": 1, "abcdefgh": 10, "abcdefghi": 100, "abcdefghij": 1000, "bbcdefg": 10, "zzzzzzz": 5}
    got = {r[0]: r for r in grouped(spark, counts)}
    assert got["abcdefg"][1:3] == ("abcdefgh", "abcdefghij")
    assert got["abcdefg"][4:] == (2, 10)
    assert got["zzzzzzz"] == ("zzzzzzz", None, "zzzzzzz", 5, 0, None)


def test_no_words(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert variants.variant_groups(empty).collect() == []
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "short once")], DOCS)
    assert variants.spelling_variants(docs).collect() == []
    assert variants.spelling_variants(docs.limit(0)).collect() == []


def test_bounds_number_shared_prefixes_alike():
    bounds = variants._Bounds(["abc", "abd", "b"])
    paths = bounds.paths
    assert paths[0][:3] == paths[1][:3] and paths[0][3] != paths[1][3]
    assert paths[2][0] == paths[0][0] and paths[2][1] not in paths[0] + paths[1]


def test_continued_crc32():
    texts = ["", "a", "añb", "x" * 64, "y" * 65, "z" * 300]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw) + b"\0" * 8, np.uint8)
    lengths = np.array([len(r) for r in raw])
    starts = np.cumsum(lengths) - lengths
    before = np.array([zlib.crc32(f"{i}:".encode()) for i in range(len(raw))], np.uint32)
    got = variants.continued_crc32(data, starts, lengths, before)
    assert got.tolist() == [zlib.crc32(f"{i}:".encode() + r) for i, r in enumerate(raw)]


def runs_of(text):
    lowered = re.findall("[A-Za-zÀ-ÿ]+", text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in lowered]


ODD = [None, "", " ", "É ÀÉ Ünder×÷ straße ǅ ßß", "İstanbul kKelvin", "ábcdefg", "日本ABCÿ", "x" * 300, "ÀÀÃ\u0083abc"]


def test_letter_spans():
    import pyarrow as pa

    for chunk in text_chunks(pa.array(ODD), table=LOWER):
        starts, lengths, points, document = variants.letter_spans(chunk)
        got = [[] for _ in ODD]
        for a, n, p, d in zip(starts, lengths, points, document, strict=True):
            word = chunk.data[a : a + n].tobytes().decode()
            assert len(word) == p
            got[d].append(word)
    assert got == [runs_of(t) for t in ODD]


def brute_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for w in runs_of(text):
            h = zlib.crc32(f"{doc_id}:{w}".encode())
            if doc_id is not None and h % 31 == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1 :]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_query_equals_brute_force(spark, tmp_path):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [*ODD, "Longwörds longwörds LONGWORDS " * 40, "Repeated repeated repeatd", "y" * 2000 + " " + "y" * 2000]
    extra = spark.createDataFrame([(-i, t) for i, t in enumerate(texts)] + [(None, "nulls nullify nullify"), (5, texts[9])], DOCS)
    rows = documents.select("doc_id", "text").union(extra)
    rows.withColumn("n", F.lit("clash")).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op12_spelling_variants"](spark, str(tmp_path)).select("word", "form", "root", "n", "n_near", "form_n")
    counts = brute_counts([(r.doc_id, r.text) for r in rows.collect()])
    # near words by deletion lists, itself checked against the definition above
    at = {}
    for w in counts:
        for v in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            at.setdefault(v, []).append(w)
    near = {w: set() for w in counts}
    for found in at.values():
        for a in found:
            near[a] |= {b for b in found if is_near(a, b)}
    forms = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        if best and counts[best] >= 10 * counts[w]:
            forms[w] = best
    want = []
    for w, n in counts.items():
        root = w
        while root in forms:
            root = forms[root]
        want.append((w, forms.get(w), root, n, len(near[w]), counts.get(forms.get(w))))
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert len(forms) >= 10
