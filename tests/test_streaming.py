import json

import pytest
from test_io import document

from vialens.operators import transform, validate
from vialens.plans import medallion
from vialens.sources import readers
from vialens.streaming import jobs


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for n in range(3):
        (folder / f"{n}.json").write_text(json.dumps(document(n)))
    (folder / "bad.json").write_text("{")
    return folder


def add(folder):
    (folder / "later.json").write_text(json.dumps(document(7, metadata={"weather": ""})))


def finish(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_routing_equals_the_batch(spark, source, tmp_path):
    target, state = str(tmp_path / "out"), str(tmp_path / "state")
    finish(jobs.route_stream(spark, str(source), target, state, batch_files=2))
    assert len(list((tmp_path / "out").glob("batch=*"))) == 2
    add(source)
    finish(jobs.route_stream(spark, str(source), target, state))  # only the new file
    columns = ["file_name", "is_valid", "errors"]
    streamed = spark.read.parquet(target).select(*columns).collect()
    batch = validate.validated(readers.raw_documents(spark, f"{source}/*.json"))
    assert sorted(map(tuple, streamed)) == sorted(map(tuple, batch.select(*columns).collect()))


def test_scoring_equals_the_batch(spark, source, tmp_path):
    mapping = transform.category_mapping(spark)
    gold = spark.createDataFrame(
        [("clear", "night", "highway", "vehicle", 2.0, 2, 2, 2, 2, 2)],
        "weather string, timeofday string, scene string, mapped_category string, avg_count double, "
        "q1_count long, median_count long, q3_count long, min_count long, max_count long",
    )
    target, state = str(tmp_path / "out"), str(tmp_path / "state")
    finish(jobs.score_stream(spark, str(source), mapping, lambda: gold, target, state))
    add(source)
    finish(jobs.score_stream(spark, str(source), mapping, lambda: gold, target, state))
    lake = medallion.Lake(str(tmp_path / "lake"))
    medallion.cleanse(spark, lake, f"{source}/*.json")
    medallion.refine(spark, lake)
    gold.write.parquet(lake.path("srv_attribute_analysis"))
    medallion.score(spark, lake, mapping)
    batch = lake.read(spark, "scene_comparison")
    streamed = spark.read.parquet(target).select(*batch.columns).collect()
    assert sorted(map(tuple, streamed)) == sorted(map(tuple, batch.collect()))
    assert len(streamed) == 4 and {r.level for r in streamed} == {"below_normal"}
