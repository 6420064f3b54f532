"""Graph search against the exact search."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vialens.operators import graph, retrieval

SCHEMA = "id long, embedding array<float>, kind string"


def clustered(seed, n, width, clusters):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(clusters, width))
    points = centres[draw.integers(0, clusters, n)] + 0.4 * draw.normal(size=(n, width))
    return [(i, p.astype("float32").tolist(), f"k{i % 10}") for i, p in enumerate(points)]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    rows = clustered(1, 4000, 24, 30)
    rows += [(5000 + i, rows[3][1], "copy") for i in range(40)]
    rows += [(6000, [0.0] * 24, "k0"), (6001, None, "k1"), (None, rows[0][1], "k1")]
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(4)
    folder = str(tmp_path_factory.mktemp("graph") / "shards")
    # two shards
    index = graph.build_graph(vectors, folder, label="kind", shard_bytes=4041 * 24 * 8 // 2 + 1000)
    return vectors.where("id is not null"), graph.open_graph(spark, folder), index


def queries_of(vectors):
    some = vectors.where("id % 40 = 0 and embedding is not null").select(F.col("id").alias("query_id"), "embedding", "kind")
    return some


def test_recall_and_share_visited(built):
    vectors, index, same = built
    assert index.n_vectors == same.n_vectors == 4041
    assert index.shards.count() == 2
    queries = queries_of(vectors)
    hits = graph.graph_top_k(index, queries, k=10, effort=30).cache()
    exact = retrieval.top_k(queries, vectors, k=10)
    measured = graph.recall(hits, exact).first()
    visited = hits.groupBy("query_id").agg(F.max("n_scored").alias("n")).agg(F.avg("n")).first()[0]
    print("recall", measured["recall"], "share visited", visited / index.n_vectors)
    assert measured["recall"] >= 0.95
    assert visited <= 0.35 * index.n_vectors
    # found hits have the exact search's scores
    both = hits.join(exact.withColumnRenamed("score", "s"), ["query_id", "id"])
    assert both.where(F.abs(F.col("score") - F.col("s")) > 2e-9).count() == 0
    ranks = hits.groupBy("query_id").agg(F.collect_set("rank").alias("r")).collect()
    assert all(sorted(r.r) == list(range(1, 11)) for r in ranks)


def test_more_effort_finds_more(built):
    vectors, index, _ = built
    queries = queries_of(vectors)
    exact = retrieval.top_k(queries, vectors, k=10)
    few, many = (graph.recall(graph.graph_top_k(index, queries, effort=e), exact).first()["recall"] for e in (10, 400))
    assert few <= many and many >= 0.99


def test_filter_during_the_walk(built, monkeypatch):
    """A tenth of the vectors match; with FEW at 0 the walk has to find them."""
    vectors, index, _ = built
    queries = queries_of(vectors).withColumn("wanted", F.lit("k3"))
    exact = retrieval.top_k(queries, vectors.where("kind = 'k3'"), k=5)
    scanned = graph.graph_top_k(index, queries, k=5)
    assert graph.recall(scanned, exact).first()["recall"] == 1.0
    monkeypatch.setattr(graph, "FEW", 0)
    walked = graph.graph_top_k(index, queries, k=5, effort=60)
    assert graph.recall(walked, exact).first()["recall"] >= 0.95
    kinds = walked.join(vectors, "id").select("kind").distinct().collect()
    assert [r.kind for r in kinds] == ["k3"]


def test_small_groups_are_scored_whole(built):
    vectors, index, _ = built
    queries = queries_of(vectors).withColumn("wanted", F.lit("copy"))
    hits = graph.graph_top_k(index, queries, k=10)
    exact = retrieval.top_k(queries, vectors.where("kind = 'copy'"), k=10)
    assert sorted(map(tuple, hits.drop("n_scored").collect())) == sorted(map(tuple, exact.collect()))
    assert hits.select("n_scored").distinct().first()[0] == 40


def test_queries_in_slices(built):
    vectors, index, _ = built
    queries = queries_of(vectors)
    whole, sliced = (sorted(map(tuple, graph.graph_top_k(index, queries, query_limit=n).collect())) for n in (1024, 9))
    assert whole == sliced


def test_text_ids_few_vectors_and_none(spark, tmp_path):
    rows = [("a", [1.0, 0.0]), ("b", [2.0, 0.1]), ("c", [0.0, 1.0])]
    vectors = spark.createDataFrame(rows, "id string, embedding array<double>")
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "query_id long, embedding array<double>")
    index = graph.build_graph(vectors, str(tmp_path / "few"))
    assert [r.id for r in graph.graph_top_k(index, queries, k=2).orderBy("rank").collect()] == ["a", "b"]
    assert graph.graph_top_k(index, queries.limit(0)).collect() == []
    empty = graph.build_graph(vectors.limit(0), str(tmp_path / "none"))
    assert graph.graph_top_k(empty, queries).collect() == []
    one = graph.build_graph(vectors.limit(1), str(tmp_path / "one"))
    assert graph.graph_top_k(one, queries).count() == 1


def test_links_leave_in_small_batches():
    """Links are held for a few rows at a time, however many rows a batch has."""
    draw = np.random.default_rng(3)
    rows = [[{"w": 100 * i + j, "v": draw.normal(size=4).tolist()} for j in range(i % 30)] for i in range(1000)]
    member = pa.struct([("w", pa.int64()), ("v", pa.list_(pa.float64()))])
    batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(member))], ["m"])
    out = pa.schema([("u", pa.int64()), ("w", pa.int64()), ("score", pa.float64())])
    links = list(graph._compared(iter([batch.slice(5)]), out))
    assert len(links) == 4 and max(b.num_rows for b in links) <= graph.GROUPS * 30 * graph.DEGREE
    table = pa.Table.from_batches(links)
    sizes = [len(r) for r in rows[5:]]
    assert table.num_rows == sum(n * min(graph.DEGREE, n - 1) for n in sizes if n > 1)
    vectors = {m["w"]: np.array(m["v"]) for r in rows for m in r}
    for u, w, score in list(zip(*(c.to_pylist() for c in table.columns), strict=True))[::97]:
        a, b = vectors[u], vectors[w]
        assert u // 100 == w // 100 and score == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b))


def test_places_of_linked_ids():
    ids, links = pa.array([7, 5, 9, 5]), pa.chunked_array([[5, 7], [], [9]], pa.int64())
    assert graph._places(ids, links).tolist() == [3, 0, 2]
    assert graph._places(ids, links.slice(0, 0)).dtype == np.int32
    texts = graph._places(pa.array(["b", "a"]), pa.chunked_array([["a", "b"]]))
    assert texts.tolist() == [1, 0]
    with pytest.raises(ValueError):
        graph._places(ids, pa.chunked_array([[6]]))


def test_links_stay_in_their_shard(spark, tmp_path, monkeypatch):
    """Vectors move once; no round writes a table, and a search moves no shard."""
    vectors = spark.createDataFrame(clustered(4, 600, 8, 5), SCHEMA).repartition(3)
    written, settle = [], graph.settle
    monkeypatch.setattr(graph, "settle", lambda df: written.append(df.columns) or settle(df))
    monkeypatch.setattr(graph, "SHARD_ROWS", 200)
    monkeypatch.setattr(graph, "HELD", 500)
    monkeypatch.setattr(graph, "GATHERED", 64)
    index = graph.build_graph(vectors, str(tmp_path / "shards"), label="kind")
    assert written == []
    assert index.n_vectors == 600 and index.shards.count() == 3
    assert index.shards.select(F.input_file_name()).distinct().count() == 3
    queries = queries_of(vectors)
    hits = graph.graph_top_k(index, queries, k=10)
    assert "hashpartitioning(shard" not in hits._jdf.queryExecution().executedPlan().toString()
    assert graph.recall(hits, retrieval.top_k(queries, vectors, k=10)).first()["recall"] >= 0.95
    monkeypatch.setattr(graph, "SENT_LIMITS", 2)
    sliced = graph.graph_top_k(index, queries, k=10, query_limit=3)
    assert sorted(map(tuple, sliced.collect())) == sorted(map(tuple, hits.collect()))


def test_nearest_in_a_shard():
    draw = np.random.default_rng(2)
    ids = draw.permutation(500) * 7 - 900
    vectors = draw.normal(size=(500, 6)).astype("float32")
    column = pa.array(vectors.tolist(), pa.list_(pa.float32()))
    u, w, score = graph._Links(pa.array(ids), column).nearest()
    units = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    exact = units @ units.T
    np.fill_diagonal(exact, -1)
    assert np.allclose(exact[u, w], score)
    best = np.argsort(-exact, axis=1)[:, : graph.DEGREE]
    found = set(zip(u.tolist(), w.tolist()))
    assert sum((i, j) in found for i in range(500) for j in best[i].tolist()) >= 0.95 * 500 * graph.DEGREE


def test_ties_are_ordered_by_sparks_hash(spark):
    rows = [(0, 1), (-5, 2**62), (7, -(2**63)), (123456789, 3)]
    want = [r[0] for r in spark.createDataFrame(rows, "u long, w long").select(F.xxhash64("u", "w")).collect()]
    u, w = (np.array(c, np.int64) for c in zip(*rows))
    assert graph._xxhash64(w, graph._xxhash64(u, None)).view(np.int64).tolist() == want


def test_an_id_that_repeats_has_its_links_as_often(spark, tmp_path):
    rows = clustered(6, 60, 4, 3)
    vectors = spark.createDataFrame([*rows, rows[7]], SCHEMA).coalesce(1)
    row = graph.build_graph(vectors, str(tmp_path / "shards")).shards.first()
    last = max(i for i, x in enumerate(row.ids) if x == 7)
    linked = row.links[row.first[last] : row.first[last + 1]]
    assert linked and all(linked.count(x) == 2 for x in linked)
    assert row.ids.count(7) == 2 and row.ids.index(7) not in row.links
