"""Keyword search against BM25 spelled out in Python."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from vialens.operators import keyword

QUERIES = "query_id long, text string"


def terms_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(keyword.WORD, lowered)


def plain_scores(documents, queries):
    counts = defaultdict(Counter)
    for i, text in documents:
        if i is not None:
            counts[i].update(terms_of(text))
    counts = {i: c for i, c in counts.items() if c}
    df = Counter(t for c in counts.values() for t in c)
    n, mean = len(counts), sum(sum(c.values()) for c in counts.values()) / max(len(counts), 1)
    out = {}
    for q, text in queries:
        for t, times in Counter(terms_of(text)).items():
            idf = math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5))
            for i, c in counts.items():
                if c[t]:
                    w = c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean))
                    out[q, i] = out.get((q, i), 0) + times * idf * w
    return {key: round(s, 9) for key, s in out.items()}


def plain_top_k(documents, queries, k):
    by_query = defaultdict(list)
    for (q, i), s in plain_scores(documents, queries).items():
        by_query[q].append((-s, i))
    return sorted((q, r + 1, i) for q, found in by_query.items() for r, (_, i) in enumerate(sorted(found)[:k]))


def corpus(seed, n=600):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    documents = [(i, " ".join(["The", *draw.choices(words, weights, k=draw.randint(1, 60))])) for i in range(n)]
    documents += [(n + i, documents[7][1]) for i in range(n // 3)]  # a third are copies
    documents += [(5000, None), (5001, " .,; "), (None, "w1 w2"), (3, "w399 again"), (5002, "Ünï—ß 日本 x1")]
    queries = [(q, " ".join(draw.choices(words, k=draw.randint(1, 5)))) for q in range(12)]
    queries += [(50, "the the W1!"), (51, ""), (52, None), (53, "unknown"), (54, documents[7][1]), (55, "日本 Ünï")]
    return documents, queries


def tables(spark, documents, queries):
    rows = spark.createDataFrame([(i, t, "x", 1) for i, t in documents], "id long, content string, term string, block int")
    return rows.repartition(5), spark.createDataFrame(queries, QUERIES)


@pytest.mark.parametrize("seed,block,k", [(1, 128, 10), (2, 7, 3), (3, 1, 5), (4, 10_000, 10)])
def test_hits_equal_scoring_everything(spark, tmp_path, seed, block, k):
    documents, queries = corpus(seed)
    rows, asked = tables(spark, documents, queries)
    index = keyword.build_index(rows, str(tmp_path / "index"), block_documents=block)
    hits = keyword.keyword_top_k(index, asked, k).collect()
    assert sorted((r.query_id, r["rank"], r.id) for r in hits) == plain_top_k(documents, queries, k)
    want = plain_scores(documents, queries)
    assert all(r.score == pytest.approx(want[r.query_id, r.id], abs=2e-9) for r in hits)


def test_all_scores_and_bounds(spark, tmp_path):
    documents, queries = corpus(5, 200)
    rows, asked = tables(spark, documents, queries)
    index = keyword.build_index(rows, str(tmp_path / "index"), block_documents=16)
    got = {(r.query_id, r.id): r.score for r in keyword.all_scores(index, asked).collect()}
    want = plain_scores(documents, queries)
    assert got.keys() == want.keys()
    bounds = {(r.query_id, r.block): r.bound for r in keyword.block_bounds(index, asked).collect()}
    block_of = {}
    for r in index.postings.select("block", F.explode("documents.id").alias("id")).distinct().collect():
        block_of[r.id] = r.block
    assert all(s <= bounds[q, block_of[i]] + 1e-8 for (q, i), s in want.items())


def test_blocks_that_cannot_hold_a_hit_are_skipped(spark, tmp_path):
    """One block has short documents of a rare word; the common word alone never reaches them."""
    documents = [(i, "common " + " ".join(f"x{i}y{j}" for j in range(30))) for i in range(2000)]
    documents += [(3000 + i, "common rare rare") for i in range(20)]
    rows, asked = tables(spark, documents, [(1, "common rare"), (2, "common")])
    index = keyword.build_index(rows, str(tmp_path / "index"), block_documents=20)
    share = {r.query_id: (r.n_scored, r.n_blocks) for r in keyword.pruning(index, asked, 10).collect()}
    assert share[1] == (1, 101)
    assert share[2][1] == 101
    hits = keyword.keyword_top_k(index, asked.where("query_id = 1"), 10).collect()
    assert sorted(r.id for r in hits) == list(range(3000, 3010))


def test_a_common_term_is_cut_into_blocks(spark, tmp_path):
    rows = spark.range(1000).select("id", F.lit("same word").alias("content"))
    index = keyword.build_index(rows, str(tmp_path / "index"), block_documents=64)
    sizes = [r.n for r in index.postings.where("term = 'same'").select(F.size("documents").alias("n")).collect()]
    assert len(sizes) == 16 and max(sizes) == 64


def test_opened_again_and_empty(spark, tmp_path):
    documents, queries = corpus(6, 50)
    rows, asked = tables(spark, documents, queries)
    keyword.build_index(rows, str(tmp_path / "index"))
    index = keyword.open_index(spark, str(tmp_path / "index"))
    hits = keyword.keyword_top_k(index, asked, 2).collect()
    assert sorted((r.query_id, r["rank"], r.id) for r in hits) == plain_top_k(documents, queries, 2)
    assert keyword.keyword_top_k(index, asked.limit(0), 2).collect() == []
    empty = keyword.build_index(rows.limit(0), str(tmp_path / "empty"))
    assert keyword.keyword_top_k(empty, asked, 2).collect() == []


def test_terms_of_few_queries_reach_the_scan(spark, tmp_path):
    documents, queries = corpus(7, 50)
    rows, asked = tables(spark, documents, queries)
    index = keyword.build_index(rows, str(tmp_path / "index"))
    bounds = keyword.block_bounds(index, asked)
    plan = bounds._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "In(term" in plan
    assert "documents" not in plan.split("ReadSchema")[-1]


def test_fused_ranks(spark):
    schema = "query_id long, rank int, id long, score double"
    a = spark.createDataFrame([(1, 1, 10, 9.0), (1, 2, 11, 8.0), (2, 1, 5, 1.0)], schema)
    b = spark.createDataFrame([(1, 1, 12, 0.5), (1, 2, 10, 0.4), (1, 3, 11, 0.3)], schema)
    got = [(r.query_id, r["rank"], r.id, r.score) for r in keyword.fused([a, b], 3).orderBy("query_id", "rank").collect()]
    assert got == [
        (1, 1, 10, round(1 / 61 + 1 / 62, 9)),
        (1, 2, 11, round(1 / 62 + 1 / 63, 9)),
        (1, 3, 12, round(1 / 61, 9)),
        (2, 1, 5, round(1 / 61, 9)),
    ]


def test_a_block_is_written_and_scored_in_one_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyword, "TASK_WORDS", 2000, raising=False)
    monkeypatch.setattr(keyword, "TASK_SCORES", 500, raising=False)
    documents, queries = corpus(8)
    rows, asked = tables(spark, documents, queries)
    index = keyword.build_index(rows, str(tmp_path / "index"), block_documents=16)
    files = index.postings.select("block", F.input_file_name().alias("file")).distinct()
    assert files.select("file").distinct().count() > 3
    assert files.groupBy("block").count().where("count > 1").count() == 0
    # neither postings by term nor scores by query and document are sent anywhere
    scores = keyword.all_scores(index, asked)
    plan = scores._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\(([^,)]*)", plan)
    assert any(d.startswith("block") for d in dealt)
    assert not any(d.startswith(("query_id", "id")) for d in dealt)
    want = plain_scores(documents, queries)
    assert {(r.query_id, r.id): r.score for r in scores.collect()} == pytest.approx(want, abs=2e-9)
    hits = keyword.keyword_top_k(index, asked, 5).collect()
    assert sorted((r.query_id, r["rank"], r.id) for r in hits) == plain_top_k(documents, queries, 5)
    # pairs of query and block that are too many for every task
    monkeypatch.setattr(keyword, "BROADCAST_PAIRS", 0)
    assert sorted(hits) == sorted(keyword.keyword_top_k(index, asked, 5).collect())


def test_neither_words_nor_scores_become_rows(spark, tmp_path, monkeypatch):
    documents, queries = corpus(9)
    rows, asked = tables(spark, documents, queries)
    index = keyword.build_index(rows, str(tmp_path / "index"), block_documents=16)
    plan = keyword.all_scores(index, asked)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
    wanted, postings = keyword._query_terms(index, asked)
    hits, more = keyword._waves(index, wanted, postings, 3)
    least = {r.query_id: r.score for r in hits.where("rank = 3").collect()}
    later = keyword._scored(index, wanted, postings, more).collect()
    assert all(r.score >= least.get(r.query_id, 0) - 2e-9 for r in later)
    # queries in slices, and a slice in parts of the matrix
    want = sorted(keyword.keyword_top_k(index, asked, 5).collect())
    monkeypatch.setattr(keyword, "SENT_TERMS", 4)
    monkeypatch.setattr(keyword, "CELLS", 5)
    assert sorted(keyword.keyword_top_k(index, asked, 5).collect()) == want
