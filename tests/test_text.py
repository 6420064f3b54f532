from pathlib import PurePath

from pyspark.sql import functions as F

from vialens.functions import text as X
from vialens.schemas import IMAGE_EXTENSIONS


def column(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_slices_equal_python_slices(spark):
    values = ["", "a", "x" * 1500, "y" * 1501, "é😀\n" * 2000, "line\r\nline\n" * 500, None]
    got = column(spark, values, X.text_slices)
    for v, slices in zip(values, got):
        want = None if v is None else [v[i : i + 1500] for i in range(0, len(v), 1500)]
        assert slices == want


def test_name_parts(spark):
    names = ["0a0a-0b0b.jpg", "v-1-2.tar.jpg", "plain.jpg", "nodot", "-x.jpg", "x-.jpg", ".hidden"]
    video = column(spark, names, X.video_of)
    frame = column(spark, names, X.frame_of)
    for n, v, f in zip(names, video, frame):
        stem = PurePath(n).stem
        assert (v, f) == (tuple(stem.rsplit("-", 1)) if "-" in stem else (stem, None))


def test_image_names(spark):
    names = ["a.jpg", "a.JPEG", "a.b.WebP", "jpg", "a.", "a.jpg.txt", ".png", "a.tif "]
    want = ["." in n and n.split(".")[-1].lower() in IMAGE_EXTENSIONS for n in names]
    assert column(spark, names, X.is_image_name) == want


def test_first_filled(spark):
    df = spark.createDataFrame([("", "b"), (None, "b"), ("a", "b"), ("", None)], "a string, b string")
    got = [r[0] for r in df.select(X.first_filled(df.a, df.b)).collect()]
    assert got == ["b", "b", "a", None]


def test_city(spark):
    got = column(spark, ["New York Brochure.pdf", "x.pdf"], X.city_of)
    assert got == ["New York", "x.pdf"]


REPLIES = {
    # reply: (weather, timeofday, scene) where it says so
    'ok ```json\n{"weather": "clear", "scene": "x"}\n``` bye {"weather": "no"}': ("clear", None, "x"),
    '```json{"weather":"clear"}```': ("clear", None, None),
    '```json\n{"weather":"open fence"}\n': ("open fence", None, None),
    '```json {"weather":"lost"}': (None, None, None),
    'text {"timeofday":"night"} text': (None, "night", None),
    '{"a":1} and {"b":2}': (None, None, None),
    "} backwards {": (None, None, None),
    '{"attributes":{"weather":"in"},"weather":"out"}': ("in", None, None),
    '{"attributes":{},"weather":"out"}': (None, None, None),
    '{"attributes":5}': (None, None, None),
    "[1,2]": (None, None, None),
    "nothing": (None, None, None),
    "": (None, None, None),
    '{"weather":"a\\nb","scene":"s","timeofday":"t","more":[1]}': ("a\nb", "t", "s"),
    '```\n{"weather":"plain fence"}\n```': ("plain fence", None, None),
}


def test_replies(spark):
    df = spark.createDataFrame([(r,) for r in REPLIES], "v string")
    got = df.select("v", *X.reply_attributes(F.col("v"))).collect()
    for r in got:
        want = tuple(v or "unknown" for v in REPLIES[r.v])
        assert (r.weather, r.timeofday, r.scene) == want, r.v
