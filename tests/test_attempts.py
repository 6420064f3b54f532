"""Limits of successes and of failures in a row, against the plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from vialens.operators import attempts

SCHEMA = "filename string, ok boolean"


def plain(outcomes, limit, most, go_on):
    done, row, out = 0, 0, []
    for name, ok in sorted(outcomes):
        if limit is not None and done >= limit:
            break
        warns = False
        if ok:
            done, row = done + 1, 0
        else:
            row += 1
            if most is not None and row % most == 0:
                warns = True
        out.append((name, warns))
        if warns and not go_on:
            break
    return out


def outcomes_of(seed):
    draw = random.Random(seed)
    rate = [0.5, 0.1, 0.9, 0.02, 0.0, 1.0][seed % 6]
    rows = [(f"f{i:04d}", draw.random() < rate) for i in range(300)]
    if seed % 2:  # a long failure over many slices
        rows[60:220] = [(n, False) for n, _ in rows[60:220]]
    return rows


@pytest.mark.parametrize("seed,slices", [(0, 1), (1, 7), (2, 40), (3, 40), (4, 13), (5, 13)])
def test_counts_over_any_slices(spark, seed, slices):
    rows = outcomes_of(seed)
    spark.conf.set("spark.sql.shuffle.partitions", str(slices))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(random.Random(9).sample(rows, len(rows)), SCHEMA).repartition(5)
        got = {r.filename: (r.consecutive, r.succeeded_before) for r in attempts.numbered_attempts(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    row = done = 0
    for name, ok in rows:
        row = 0 if ok else row + 1
        assert got[name] == (row, done), name
        done += ok


@pytest.mark.parametrize("limit,most,go_on", [(None, None, False), (20, None, False), (20, 5, False), (20, 5, True), (None, 3, False), (None, 3, True)])
def test_attempted_equals_the_loop(spark, limit, most, go_on):
    rows = outcomes_of(7) + [("zz", None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = attempts.attempted(df, limit, most, go_on).orderBy("filename").collect()
    assert [(r.filename, r.warns) for r in got] == plain([(n, bool(ok)) for n, ok in rows], limit, most, go_on)


@pytest.mark.parametrize("seed,limit,most,go_on", [(0, 30, None, False), (1, 40, 50, False), (3, 5, None, False), (2, None, 4, False), (1, 60, 20, True)])
def test_waves_equal_the_loop_and_score_nothing_twice(spark, seed, limit, most, go_on, tmp_path):
    rows = outcomes_of(seed)
    work = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("ok", "will")
    log = tmp_path / "log"
    log.mkdir()

    def score(part):
        part.select("filename").write.mode("append").parquet(str(log / "names"))
        return part.select("filename", F.col("will").alias("ok"))

    made = attempts.in_waves(work, score, limit, most, go_on, first_wave=16)
    assert [(r.filename, r.warns) for r in made.orderBy("filename").collect()] == plain(rows, limit, most, go_on)
    scored = [r.filename for r in spark.read.parquet(str(log / "names")).collect()]
    assert len(scored) == len(set(scored))
    if seed == 0:
        assert len(scored) < 120  # 30 successes at a rate of a half


def test_no_attempts(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert attempts.attempted(none, 3, 2).collect() == []
    assert attempts.in_waves(none, lambda part: part, limit=3).collect() == []
