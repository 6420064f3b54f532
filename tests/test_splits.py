"""Reading large arrays in ranges against reading them whole."""

import json
import random

import pytest
from pyspark.sql import functions as F

from vialens.sources import readers, splits

NASTY = ['\\', '"', '\\"', '[,]', '{"a":[1,2]}', 'é ', '\\\\', ',', '}', ']', '\\u0041', 'x' * 70, '\n\t', '日本 \U0001f600']


def value(draw, depth=0):
    kind = draw.randint(0, 6 if depth < 3 else 3)
    if kind <= 1:
        return "".join(draw.choices(NASTY, k=draw.randint(0, 4)))
    if kind == 2:
        return draw.choice([None, True, False, 0, -1.5e3, 12345])
    if kind == 3:
        return draw.choice([[], {}, ""])
    if kind == 4:
        return [value(draw, depth + 1) for _ in range(draw.randint(0, 3))]
    return {value_key(draw): value(draw, depth + 1) for _ in range(draw.randint(0, 3))}


def value_key(draw):
    return draw.choice(NASTY) + str(draw.randint(0, 9))


def spaced(draw, items, indent):
    text = ("\n  ," if indent else ",").join(json.dumps(i, ensure_ascii=draw.random() < 0.5, indent=indent) for i in items)
    return draw.choice(["", " \n", "﻿"]) + "[" + draw.choice(["", " "]) + text + draw.choice(["", "\n"]) + "]" + draw.choice(["", "\n\n"])


@pytest.mark.parametrize("seed", range(40))
def test_items_of_any_cut(seed, tmp_path):
    """Without Spark: all ranges of a file, composed, give its items once and in order."""
    draw = random.Random(seed)
    items = [value(draw) for _ in range(draw.randint(0, 12))]
    raw = spaced(draw, items, draw.choice([None, 1])).encode()
    file = tmp_path / "list.json"
    file.write_bytes(raw)
    for size in (1, 2, 3, 7, 64, len(raw), 10**6):
        state, depth, found = splits.OUTSIDE, 0, []
        for part, begin in enumerate(range(0, len(raw), size)):
            n = min(size, len(raw) - begin)
            row = {"path": str(file), "length": len(raw), "part": part, "begin": begin, "n": n}
            row |= {"state": state, "depth": depth, "is_array": True}
            found += [t for _, t in splits._cut(row, size) if t.strip(splits._BLANK)]
            effect = splits.Range(raw[begin : begin + n], state)
            state, depth = effect.ends, depth + int(effect.change.sum())
        assert [json.loads(t) for t in found] == items, size
        assert (state, depth) == (splits.OUTSIDE, 0)


def frames(n, seed=1):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        box = {"x1": i, "y1": 2.5, "x2": i + 3, "y2": 4}
        label = {"id": str(i), "category": draw.choice(NASTY), "box2d": box, "attributes": {"occluded": i % 2 == 0}}
        out.append({"name": f"v{i % 7}-{i}.jpg", "attributes": {"weather": draw.choice(NASTY)}, "labels": [label] * (i % 4)})
    return out


def columns_of(df):
    return sorted(map(str, df.select("name", "attributes", "labels", "file_name", "_corrupt_record", "split").collect()))


def test_label_lists_equal_the_whole_reader_and_use_many_tasks(spark, tmp_path):
    (tmp_path / "det_train.json").write_text(json.dumps(frames(500)))
    (tmp_path / "det_val.json").write_text(json.dumps(frames(20, 2), indent=2, ensure_ascii=False))
    (tmp_path / "det_none.json").write_text("[ ]")
    path = f"{tmp_path}/det_*.json"
    whole = readers.label_lists(spark, path)
    split = splits.label_lists(spark, path, split_bytes=4096)
    assert columns_of(split) == columns_of(whole)
    assert set(split.columns) == set(whole.columns)
    tasks = splits.json_items(spark, f"{tmp_path}/det_train.json", 4096)
    used = tasks.select(F.spark_partition_id().alias("p")).distinct().count()
    n_ranges = -(-(tmp_path / "det_train.json").stat().st_size // 4096)
    assert used >= n_ranges / 2 > 10


def test_broken_and_other_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(frames(3))[:-20])
    (tmp_path / "b.json").write_text(json.dumps(frames(1)[0]))
    (tmp_path / "c.json").write_text("")
    (tmp_path / "d.json").write_text('[{"name":"x"}, {"name": oops}, {"name":"y"}][{"name":"z"}]')
    for size in (5, 10**6):
        got = splits.label_documents(spark, f"{tmp_path}/*.json", size)
        rows = sorted((r.file_name, r.name or "", r._corrupt_record is not None) for r in got.collect())
        assert rows == [
            ("a.json", "", True), ("a.json", "v0-0.jpg", False), ("a.json", "v1-1.jpg", False),
            ("b.json", "v0-0.jpg", False),
            ("d.json", "", True), ("d.json", "x", False), ("d.json", "y", False), ("d.json", "z", False),
        ]
    assert splits.json_items(spark, f"{tmp_path}/c.json").collect() == []
