import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from vialens.operators import retrieval


def plain_top_k(queries, docs, k):
    out = []
    for q, v in queries:
        scores = []
        for i, d in docs:
            norm = np.linalg.norm(v) * np.linalg.norm(d)
            scores.append((-round(float(np.dot(v, d) / norm) if norm else 0.0, 9), i))
        out += [(q, rank + 1, i) for rank, (_, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    docs = [(i, rng.normal(size=8).astype("float32").tolist()) for i in range(400)]
    docs += [(400 + i, docs[i % 3][1]) for i in range(200)]  # a third are copies
    docs.append((999, [0.0] * 8))
    queries = [(q, rng.normal(size=8).astype("float32").tolist()) for q in range(30)]
    queries.append((30, docs[0][1]))
    return (
        queries,
        docs,
        spark.createDataFrame(queries, "query_id long, embedding array<float>"),
        spark.createDataFrame(docs, "id long, embedding array<float>").repartition(6),
    )


@pytest.mark.parametrize("limit", [1024, 7])
def test_top_k_is_exact(spark, vectors, limit, monkeypatch):
    """All queries at once, or both sides split into cells: the same ranking."""
    monkeypatch.setattr(retrieval, "CELL_ROWS", 150)
    queries, docs, q, d = vectors
    hits = retrieval.top_k(q, d, 5, query_limit=limit).collect()
    assert sorted((r.query_id, r["rank"], r.id) for r in hits) == plain_top_k(queries, docs, 5)
    best = {r.query_id: r.score for r in hits if r["rank"] == 1}
    assert best[30] == pytest.approx(1.0)


def test_documents_are_not_shuffled(spark, vectors):
    *_, q, d = vectors
    plan = retrieval.top_k(q, d.coalesce(6), 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2  # the fixture's repartition, and the ranking
    assert "WindowGroupLimit" in plan


def test_text_ids_empty_sides_and_bad_lengths(spark):
    q = spark.createDataFrame([("a", [1.0, 0.0])], "query_id string, embedding array<double>")
    d = spark.createDataFrame(
        [("y", [1.0, 0.0]), ("x", [2.0, 0.0]), ("n", None)], "id string, embedding array<double>"
    )
    assert [r.id for r in retrieval.top_k(q, d, 3).orderBy("rank").collect()] == ["x", "y"]
    assert retrieval.top_k(q.limit(0), d).count() == 0
    assert retrieval.top_k(q, d.limit(0)).count() == 0
    odd = spark.createDataFrame([("z", [1.0])], "id string, embedding array<double>")
    with pytest.raises(Exception, match="differ in length"):
        retrieval.top_k(q, odd).collect()


def test_context(spark):
    docs = spark.createDataFrame(
        [(1, "one", "W"), (2, "two", "W"), (3, "three", "V")], "id long, content string, source string"
    )
    hits = spark.createDataFrame(
        [(7, 2, 1, 0.5), (7, 1, 3, 0.9)], "query_id long, rank int, id long, score double"
    )
    found = retrieval.hits_with_content(hits, docs)
    assert found.columns == ["query_id", "rank", "content", "source"]
    text = retrieval.context_texts(found).head().system_text
    assert text == (
        retrieval.CONTEXT_HEAD + "Source: V => three\nSource: W => one" + retrieval.CONTEXT_TAIL
    )


def test_shaped_documents(spark):
    corpus = spark.createDataFrame(
        [(30, "p", "t"), (10, None, "t"), (20, None, None)], "pos long, passage string, text string"
    )
    got = {r.pos: (r.id, r.content) for r in
           retrieval.shaped_documents(corpus, "pos", F.lit("W")).collect()}
    assert got[10] == ("doc_0", "t") and got[30] == ("doc_2", "p")
    assert got[20][0] == "doc_1" and '"pos":20' in got[20][1]


def test_chunks_keep_their_ids(spark):
    docs = spark.createDataFrame(
        [("Rome Brochure.pdf", "a" * 3200), ("Oslo Brochure.pdf", "")], "filename string, text string"
    )
    first, again = (sorted(map(tuple, retrieval.chunk_table(docs).collect())) for _ in range(2))
    assert first == again and len({r[0] for r in first}) == 3
    assert {r[1] for r in first} == {"Rome"}


def test_transcripts_of_a_long_thread(spark):
    turns = [(1, i, ("user", "assistant", "system")[i % 3], f"t{i}") for i in range(300)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    parts = sorted(retrieval.transcripts(df, 64).collect(), key=lambda r: r.part)
    whole = "\n".join(p.transcript for p in parts)
    assert whole == "\n".join(f"{r}: {t}" for _, _, r, t in turns if r != "system")
    assert len(parts) == 5 and max(p.n_turns for p in parts) <= 64
    assert retrieval.last_assistant(df).head().text == "t298"


def test_qa_pairs(spark):
    df = spark.createDataFrame([("q", None)], "question string, answer string")
    assert tuple(retrieval.qa_pairs(df).head()) == ("q", "")


def test_many_queries_meet_many_vectors_in_tiles():
    draw = np.random.default_rng(5)
    vectors, queries = draw.normal(size=(20_000, 8)), draw.normal(size=(2_048, 8))
    tracemalloc.start()
    running = retrieval._Running(list(range(len(queries))), queries, 3)
    running.add(np.arange(12_000), vectors[:12_000])
    running.add(np.arange(12_000, 20_000), vectors[12_000:])
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 64 << 20  # all scores are 312 MB
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    for q in range(0, len(queries), 97):
        scores = np.round(units @ (queries[q] / np.linalg.norm(queries[q])), 9)
        assert running.kept[q][1].tolist() == np.lexsort((np.arange(20_000), -scores))[:3].tolist()


def test_split_sides_of_many_slices(spark, vectors, monkeypatch):
    for name, value in (("CELL_ROWS", 150), ("CELL_LIMITS", 1), ("TILE_SCORES", 7)):
        monkeypatch.setattr(retrieval, name, value)
    _, _, q, d = vectors
    want = sorted(map(tuple, retrieval.top_k(q, d, 5).collect()))
    assert sorted(map(tuple, retrieval.top_k(q, d, 5, query_limit=2).collect())) == want
