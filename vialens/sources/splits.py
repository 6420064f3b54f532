"""Large JSON arrays read by many tasks, cut at true item boundaries.

A file is cut into byte ranges that know nothing of each other. Whether a range
begins inside a string, or how deep, depends on all before it. So each range is
read once to tell what it does to the three states it may begin in (outside
strings, inside one, inside one after a backslash): the state it ends in and the
change of depth. These small functions compose in order of the ranges, which
gives every range its true beginning. Then the ranges are read again: an item
belongs to the range that holds the bracket or comma before it, and its task
reads on past the range's end until the item ends.

A file that is no array is one item. Space between items is no item. Of several
arrays one after the other all items count. An array that breaks off ends with an
item that does not parse.
"""

from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vialens import schemas
from vialens.operators.scale import settle
from vialens.sources.readers import file_listing

SPLIT_BYTES = 16 << 20
OUTSIDE, INSIDE, ESCAPED = 0, 1, 2

_QUOTE, _BACKSLASH, _COMMA = b'"\\,'
_OPEN, _CLOSE = b"[{", b"]}"
_BLANK = b" \t\r\n\xef\xbb\xbf"  # and the mark at a file's start

_DEPTH = np.zeros(256, np.int8)
_DEPTH[list(_OPEN)] = 1
_DEPTH[list(_CLOSE)] = -1
_SPECIAL = _DEPTH != 0
_SPECIAL[[_QUOTE, _COMMA]] = True


class Range:
    """The characters of a byte range that shape JSON, from a known state on."""

    def __init__(self, data: bytes, state: int):
        raw = np.frombuffer(data, np.uint8)
        at = np.arange(len(raw))
        back = raw == _BACKSLASH
        if state == ESCAPED and len(raw):
            back[0] = False
        # a character is escaped if an odd number of backslashes stands before it
        plain = np.maximum.accumulate(np.where(back, -1, at)) if len(raw) else at
        run = np.zeros(len(raw) + 1, np.int64)
        run[1:] = at - plain
        escaped = run[:-1] % 2 == 1
        if state == ESCAPED and len(raw):
            escaped[0] = True
        keep = _SPECIAL[raw] & ~((raw == _QUOTE) & escaped)
        self.at = np.flatnonzero(keep)
        self.char = raw[self.at]
        quotes = self.char == _QUOTE
        inside = (np.cumsum(quotes) + (state != OUTSIDE)) % 2 == 1
        if len(raw) == 0:
            self.ends = state
        elif not (inside[-1] if len(inside) else state != OUTSIDE):
            self.ends = OUTSIDE
        else:
            self.ends = ESCAPED if run[-1] % 2 == 1 else INSIDE
        free = ~inside & ~quotes
        self.at, self.char = self.at[free], self.char[free]
        self.change = _DEPTH[self.char].astype(np.int64)

    def marks(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(places of a top array's brackets and commas, whether an item may begin there)."""
        before = depth + np.cumsum(self.change) - self.change
        begins = (before == 0) & (self.char == _OPEN[0]) | (before == 1) & (self.char == _COMMA)
        either = np.flatnonzero(begins | (before == 1) & (self.change < 0))
        return self.at[either], begins[either]


def _reader(path: str):
    """(function of offset and number of bytes) for a file, from any store pyarrow can name."""
    store, inner = fs.FileSystem.from_uri(quote(path.replace("s3a://", "s3://", 1), safe="/:@"))
    file = store.open_input_file(inner)
    return file, lambda offset, n: file.read_at(n, offset)


_RANGE = "path string, filename string, length long, part long, begin long, n long"


def _ranges(files: DataFrame, split_bytes: int) -> DataFrame:
    last = F.floor((F.col("length") - 1) / split_bytes)
    parts = files.where(F.col("length") > 0).select(
        "path", "filename", "length", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("part")
    )
    begin = F.col("part") * split_bytes
    n = F.least(F.col("length") - begin, F.lit(split_bytes).cast("long"))
    return parts.withColumns({"begin": begin, "n": n})


def _apart(ranges: DataFrame) -> DataFrame:
    """A range a task: a row is small, what it stands for is not."""
    return ranges.repartition(max(1, ranges.count()))


def _effects(ranges: DataFrame) -> DataFrame:
    """(path, part, ends, deeper, first): by beginning state, where a range ends and how much deeper."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file, read = _reader(row["path"])
                with file:
                    data = read(row["begin"], row["n"])
                found = [Range(data, state) for state in (OUTSIDE, INSIDE, ESCAPED)]
                visible = data.lstrip(_BLANK)[:1]
                out = {
                    "path": [row["path"]],
                    "part": [row["part"]],
                    "ends": [[r.ends for r in found]],
                    "deeper": [[int(r.change.sum()) for r in found]],
                    "first": [visible.decode("latin-1") or None],
                }
                yield pa.RecordBatch.from_pydict(out, _EFFECT)

    return ranges.mapInArrow(judge, "path string, part long, ends array<long>, deeper array<long>, first string")


_EFFECT = pa.schema(
    [
        ("path", pa.string()),
        ("part", pa.int64()),
        ("ends", pa.list_(pa.int64())),
        ("deeper", pa.list_(pa.int64())),
        ("first", pa.string()),
    ]
)
_BEGIN = pa.schema(
    [("path", pa.string()), ("part", pa.int64()), ("state", pa.int64()), ("depth", pa.int64()), ("is_array", pa.bool_())]
)


def _composed(effects: DataFrame) -> DataFrame:
    """(path, part, state, depth, is_array): how every range begins. A few numbers a range meet by file."""

    def compose(table: pa.Table) -> pa.Table:
        rows = table.sort_by("part").to_pylist()
        is_array = next((r["first"] for r in rows if r["first"]), None) == "["
        state, depth, out = OUTSIDE, 0, []
        for r in rows:
            out.append({"path": r["path"], "part": r["part"], "state": state, "depth": depth, "is_array": is_array})
            state, depth = r["ends"][state], depth + r["deeper"][state]
        return pa.Table.from_pylist(out, _BEGIN)

    return effects.groupBy("path").applyInArrow(
        compose, "path string, part long, state long, depth long, is_array boolean"
    )


def _cut(row: dict, step: int) -> Iterator[tuple[int, bytes]]:
    """(offset, text) of the items that belong to a range."""
    file, read = _reader(row["path"])
    with file:
        data = read(row["begin"], row["n"])
        if not row["is_array"]:
            if row["part"] == 0:
                yield 0, data + read(row["n"], row["length"] - row["n"])
            return
        piece = Range(data, row["state"])
        places, begins = piece.marks(row["depth"])
        for a, b, begin in zip(places[:-1].tolist(), places[1:].tolist(), begins[:-1].tolist(), strict=True):
            if begin:
                yield row["begin"] + a + 1, data[a + 1 : b]
        if not len(begins) or not begins[-1]:
            return
        # the last item goes on behind the range
        parts, offset = [data[int(places[-1]) + 1 :]], row["begin"] + row["n"]
        state, depth = piece.ends, row["depth"] + int(piece.change.sum())
        while offset < row["length"]:
            more = read(offset, step)
            piece = Range(more, state)
            ends, _ = piece.marks(depth)
            parts.append(more[: int(ends[0])] if len(ends) else more)
            if len(ends):
                break
            state, depth, offset = piece.ends, depth + int(piece.change.sum()), offset + len(more)
        yield row["begin"] + int(places[-1]) + 1, b"".join(parts)


def json_items(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, filename, offset, item): the text of every element of the files' arrays.

    ``offset`` is the byte behind the bracket or comma before the item.
    """
    ranges = settle(_ranges(file_listing(spark, path), split_bytes))
    begins = _composed(settle(_effects(_apart(ranges))))
    placed = settle(ranges.join(begins, ["path", "part"]))
    step = min(split_bytes, 1 << 20)
    schema = pa.schema([("path", pa.string()), ("filename", pa.string()), ("offset", pa.int64()), ("item", pa.string())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = [(at, text) for at, text in _cut(row, step) if text.strip(_BLANK)]
                items = [text.strip(_BLANK).decode("utf-8", "replace") for _, text in found]
                out = [[row["path"]] * len(items), [row["filename"]] * len(items), [at for at, _ in found], items]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return _apart(placed).mapInArrow(cut, "path string, filename string, offset long, item string")


def label_documents(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The rows of ``readers.label_documents``, read by as many tasks as the files have ranges.

    An item that does not parse, and not its whole file, is in ``_corrupt_record``.
    """
    schema = T.StructType(
        [f for f in schemas.LABEL_DOCUMENT.fields if f.name != schemas.CORRUPT]
        + [T.StructField(schemas.CORRUPT, T.StringType())]
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
    parsed = json_items(spark, path, split_bytes).select(
        F.from_json("item", schema, options).alias("document"), F.col("filename").alias("file_name")
    )
    names = schemas.LABEL_DOCUMENT.names
    return parsed.select(*[F.col(f"document.{n}").alias(n) for n in names], "file_name")


def label_lists(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Frames of ``det_<split>.json`` lists, with their split; one large list is many tasks."""
    return label_documents(spark, path, split_bytes).withColumn(
        "split", F.regexp_extract("file_name", r"det_(.*)\.json", 1)
    )
