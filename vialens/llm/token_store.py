"""Token ids as a binary table: frequency-ranked ids in byte-aligned codes of variable length.

Format. ``ranks`` holds (rank, token_id): ids by falling count over all
documents, ties to the smaller id. ``blocks`` holds, in ascending order of
(shard, block), up to ``_CHUNK_BYTES`` of text each (a longer document is a block of
its own): the documents' ids and numbers of tokens, the ids before the block in
its shard, and two byte streams. ``control`` has two bits for every token, four
tokens a byte, lowest bits first: the number of bytes of its rank less one.
``data`` has the ranks' bytes, lowest first. Both are binary columns of
uncompressed Parquet, so any store Spark writes to will do, and a lost task's
output is never seen.

The tokenizer runs once. Drafts of the blocks rank ids by their count in the
block itself and carry these counts; once all are summed, the drafts are
recoded with the ranks of the whole corpus, block by block.
"""

import json
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vialens.llm.bytewords import Chunk, bounds, ragged, text_chunks
from vialens.llm.shared import new_folder, partitions, settle
from vialens.llm.units import Units, worker_state

_UNITS = 50
_CHUNK_BYTES = 4 << 20

_BLOCK = pa.schema(
    [
        ("shard", pa.int32()),
        ("block", pa.int32()),
        ("before", pa.int64()),
        ("n_ids", pa.int64()),
        ("doc_id", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int64())),
        ("control", pa.binary()),
        ("data", pa.binary()),
    ]
)
_BLOCK_SQL = (
    "shard int, block int, before long, n_ids long, doc_id array<long>, n_tokens array<long>, "
    "control binary, data binary"
)
_DRAFT = _BLOCK.append(pa.field("token_id", pa.list_(pa.int32()))).append(
    pa.field("n", pa.list_(pa.int64()))
)
_DRAFT_SQL = f"{_BLOCK_SQL}, token_id array<int>, n array<long>"


# codes


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit numbers."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    extra = (ranks > 0xFF).astype(np.uint8)
    extra += ranks > 0xFFFF
    extra += ranks > 0xFFFFFF
    control = np.zeros((len(ranks) + 3) // 4 * 4, np.uint8)
    control[: len(ranks)] = extra
    control = control.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)
    keep = np.arange(4, dtype=np.uint8) <= extra[:, None]
    data = ranks.view(np.uint8).reshape(-1, 4)[keep]
    return np.bitwise_or.reduce(control, axis=1, dtype=np.uint8).tobytes(), data.tobytes()


#: Number of data bytes of each of the four tokens of a control byte.
_SIZES = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
_KEEP = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers that ``pack`` was given."""
    sizes = _SIZES[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = bounds(sizes)[:-1]
    padded = np.frombuffer(data + b"\0\0\0\0", np.uint8)
    numbers = np.ndarray((max(len(padded) - 3, 0),), "<u4", padded, 0, (1,))
    return numbers[at] & _KEEP[sizes]


# encoding


class ByteLevel:
    """A byte-level tokenizer of the tokenizers library, fed with distinct units.

    A unit ends before a space that a visible character follows: there the
    library's pattern always starts a new word, whatever surrounds it. Bytes
    that may begin a white-space character outside ASCII end no unit.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.units = Units(self._contents)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec.get("pre_tokenizer") or {}
        self.by_units = (
            spec.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex") is True
            and not before.get("add_prefix_space")
            and not any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in spec["added_tokens"])
        )
        size = max(self.library.get_vocab(True).values()) + 1
        self.bytes_of = np.zeros(size, np.int64)
        for piece, i in self.library.get_vocab(True).items():
            self.bytes_of[i] = len(piece)
        for t in spec["added_tokens"]:
            self.bytes_of[t["id"]] = len(t["content"].encode())
        self.follows = np.ones(256, bool)
        self.follows[:0x21] = False
        self.follows[[0xC2, 0xE1, 0xE2, 0xE3]] = False

    def spans(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """(starts, lengths) of the units; every document that is not empty starts one."""
        n = int(chunk.offsets[-1])
        begins = np.zeros(n + 1, bool)
        if self.by_units and n:
            begins[: n - 1] = chunk.data[: n - 1] == 0x20
            begins[: n - 1] &= self.follows[chunk.data[1:n]]
        begins[chunk.offsets] = True
        begins[n] = False
        starts = np.flatnonzero(begins)
        return starts, np.diff(np.append(starts, n))

    def encode(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents, number of ids of each)."""
        starts, lengths = self.spans(chunk)
        ids, counts = self.units.ids_of(chunk, starts, lengths)
        document = np.searchsorted(chunk.offsets, starts, "right") - 1
        return ids, np.bincount(document, counts, chunk.n).astype(np.int64)

    def _contents(self, contents: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(contents)
        joined = [i for i, c in enumerate(contents) if c[:1] == b" "] if self.by_units else []
        groups = [joined[i : i + _UNITS] for i in range(0, len(joined), _UNITS)]
        texts = [b"".join(contents[i] for i in g).decode() for g in groups]
        rest = []
        for g, ids in zip(groups, self._ids(texts), strict=True):
            ends = np.cumsum(self.bytes_of[ids])
            want = np.cumsum([len(contents[i]) for i in g])
            place = np.searchsorted(ends, want)
            if len(ends) == 0 or not np.array_equal(ends[np.minimum(place, len(ends) - 1)], want):
                rest += g  # a boundary inside a token: encode these one by one
                continue
            raw, place = ids.tobytes(), [0, *((place + 1) * 4).tolist()]
            for i, (a, b) in zip(g, pairwise(place), strict=True):
                out[i] = raw[a:b]
        rest += [i for i, c in enumerate(contents) if not self.by_units or c[:1] != b" "]
        for i, ids in zip(rest, self._ids([contents[i].decode() for i in rest]), strict=True):
            out[i] = ids.tobytes()
        return out

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]


def _loaded(path: str) -> ByteLevel:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return worker_state(f"byte_level:{path}", lambda: ByteLevel(path))


def _drafts(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Blocks of (doc_id, text), with the block's ids by falling count and their counts."""

    def draft(batches: Iterator[pa.RecordBatch]):
        encoder, shard = _loaded(tokenizer), TaskContext.get().partitionId()
        number = before = 0
        for batch in batches:
            doc_ids = batch.column(0)
            for chunk in text_chunks(batch.column(1), size=_CHUNK_BYTES):
                ids, counts = encoder.encode(chunk)
                ids = np.insert(ids, np.cumsum(counts), end_id)
                n = np.bincount(ids)
                order = np.argsort(-n, kind="stable")[: np.count_nonzero(n)]
                local = np.zeros(len(n), np.uint32)
                local[order] = np.arange(len(order))
                control, data = pack(local[ids])
                row = {
                    "shard": [shard],
                    "block": [number],
                    "before": [before],
                    "n_ids": [len(ids)],
                    "doc_id": [doc_ids[chunk.first : chunk.first + chunk.n].to_pylist()],
                    "n_tokens": [counts + 1],
                    "control": [control],
                    "data": [data],
                    "token_id": [order],
                    "n": [n[order]],
                }
                yield pa.RecordBatch.from_pydict(row, _DRAFT)
                number, before = number + 1, before + len(ids)

    return docs.mapInArrow(draft, _DRAFT_SQL)


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    id: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
) -> str:
    """Encode ``docs`` into a token table at ``folder``, in ascending order of ``id``.

    Null texts are empty documents (the end id alone); null ids come first;
    rows that share an id follow each other by text; no rows make an empty table.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = docs.repartitionByRange(partitions(spark), "doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    drafts = settle(_drafts(ordered, tokenizer, end_id), compression="zstd")
    # one row a distinct id: bounded by the tokenizer's vocabulary, so the driver may hold it
    pairs = drafts.select(F.explode(F.arrays_zip("token_id", "n")).alias("p"))
    counts = pairs.groupBy("p.token_id").agg(F.sum("p.n").alias("n")).toPandas()
    counts = counts.sort_values(["n", "token_id"], ascending=[False, True])
    by_rank = counts["token_id"].to_numpy(np.int64)
    rank_of = np.zeros(int(by_rank.max(initial=end_id)) + 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank))
    spark.createDataFrame(
        [(r, int(i)) for r, i in enumerate(by_rank)], "rank long, token_id long"
    ).coalesce(1).write.parquet(f"{folder}/ranks")

    def recode(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                local = rank_of[np.array(row.pop("token_id"), np.int64)]
                ranks = local[unpack(row["control"], row["data"], row["n_ids"])]
                row["control"], row["data"] = pack(ranks)
                yield pa.RecordBatch.from_pylist([row], _BLOCK)

    blocks = drafts.drop("n").mapInArrow(recode, _BLOCK_SQL)
    blocks.write.option("compression", "none").parquet(f"{folder}/blocks")
    return folder


def read_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The blocks, with ``start``: the ids of all documents before the block."""
    blocks = spark.read.schema(_BLOCK_SQL).parquet(f"{folder}/blocks")
    # one row a shard
    sums = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shift = sums.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    joined = blocks.join(shift, "shard")
    return joined.withColumn("start", F.col("shift") + F.col("before")).drop("shift")


def _token_ids(spark: SparkSession, folder: str) -> np.ndarray:
    ranks = spark.read.schema("rank long, token_id long").parquet(f"{folder}/ranks").toPandas()
    return ranks.sort_values("rank")["token_id"].to_numpy(np.uint32)


def read_tokens(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document of a token table.

    ``ids_crc32`` is the crc32 of the ids as little-endian unsigned 32-bit
    numbers. ``ids=False`` leaves the ids themselves out.
    """
    token_ids = _token_ids(spark, folder)
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * ids
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids

    def documents(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                doc_ids, counts, n, start, control, data = (
                    batch.column(c)[i] for c in range(batch.num_columns)
                )
                counts = counts.values.to_numpy()
                found = token_ids[unpack(control.as_py(), data.as_py(), n.as_py())].astype("<u4")
                at = bounds(counts)
                raw, places = memoryview(found).cast("B"), (at * 4).tolist()
                crc = [zlib.crc32(raw[a:b]) for a, b in pairwise(places)]
                columns = [doc_ids.values, at[:-1] + start.as_py(), counts, crc]
                arrays = [pa.array(c, pa.int64()) for c in columns]
                if ids:
                    arrays.append(
                        pa.ListArray.from_arrays(pa.array(at, pa.int32()), found.astype(np.int32))
                    )
                yield pa.RecordBatch.from_arrays(arrays, names)

    blocks = read_blocks(spark, folder).select(
        "doc_id", "n_tokens", "n_ids", "start", "control", "data"
    )
    return blocks.mapInArrow(documents, schema)


def token_digests(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` as a token table in the shared folder and describe what is read back."""
    folder = write_tokens(docs, tokenizer, new_folder(docs.sparkSession, "tokens"), end_id=end_id)
    return read_tokens(docs.sparkSession, folder, ids=False)
