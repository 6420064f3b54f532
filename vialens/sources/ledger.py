"""Landing by content: files that have not changed are neither opened nor written again.

The ledger is an append-only table with a row whenever a path was found new,
changed, renamed, touched or gone. A run lists the files and opens only those
whose path, length and time the ledger does not have. Their digest tells the
rest: a known path with the same content was merely touched, a new path with the
content of one that is gone was renamed, and neither lands again.

A digest is the root of a tree: files are cut into chunks, each read and hashed by
a task of its own, and the root is the hash of the chunks' hashes in order. So a
very large file costs no task more than a chunk.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialens.operators.scale import number_rows, settle
from vialens.sources.splits import _apart, _ranges, _reader

CHUNK_BYTES = 64 << 20

LEDGER = (
    "path string, filename string, length long, modificationTime timestamp, digest string, "
    "change string, at timestamp"
)


def current(ledger: DataFrame) -> DataFrame:
    """The last entry of every path that is there."""
    row = F.struct("filename", "length", "modificationTime", "digest", "change")
    last = ledger.groupBy("path").agg(F.max_by(row, "at").alias("r")).select("path", "r.*")
    return last.where(F.col("change") != "gone")


def digests(files: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(path, digest): the root over the chunks' SHA-256; NULL for a file that cannot be read.

    ``files``: path, filename, length.
    """

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = None
                try:
                    file, read = _reader(row["path"])
                    with file:
                        data = read(row["begin"], row["n"])
                    if len(data) == row["n"]:
                        found = hashlib.sha256(data).digest()
                except OSError:
                    pass  # the NULL says so; landing reports the error with the file
                columns = [pa.array([row["path"]]), pa.array([row["part"]]), pa.array([found], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["path", "part", "leaf"])

    ranges = settle(_ranges(files.select("path", "filename", "length"), chunk_bytes))
    leaves = _apart(ranges).mapInArrow(leaf, "path string, part long, leaf binary")
    ordered = F.array_sort(F.collect_list(F.struct("part", "leaf")))
    joined = F.aggregate(ordered, F.lit(b""), lambda a, x: F.concat(a, x["leaf"]))
    whole = F.when(F.count("leaf") == F.count(F.lit(1)), F.sha2(joined, 256))
    return leaves.groupBy("path").agg(whole.alias("digest"))


def changes(files: DataFrame, ledger: DataFrame, at: Column, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """New ledger entries: what a listing has that the ledger has not, and what is gone.

    ``change`` is new, changed, touched, renamed or gone; unchanged files have no
    entry and are not opened. Of equal files one counts as renamed for every path
    that is gone with that content, in order of the paths; the others are new.
    """
    known = settle(current(ledger).select("path", "filename", "length", "modificationTime", "digest"))
    listed = settle(files.select("path", "filename", "length", "modificationTime"))
    opened = listed.join(known, ["path", "length", "modificationTime"], "left_anti")
    hashed = settle(opened.join(digests(opened, chunk_bytes), "path", "left"))
    gone = known.join(listed, "path", "left_anti")
    met = hashed.join(known.select("path", F.col("digest").alias("_was"), F.lit(True).alias("_known")), "path", "left")
    fresh = met.where(F.col("_known").isNull() & F.col("digest").isNotNull())
    # the n-th new path of a content takes the place of the n-th that is gone
    nth = lambda df: number_rows(df.select("path", "digest"), ["path"], ["digest"], "_nth")
    moved = nth(fresh).join(nth(gone).select("digest", "_nth"), ["digest", "_nth"]).select("path", F.lit(True).alias("_moved"))
    change = (
        F.when(F.col("_known") & F.col("digest").eqNullSafe(F.col("_was")), "touched")
        .when(F.col("_known"), "changed")
        .when(F.col("_moved"), "renamed")
        .otherwise("new")
    )
    there = met.join(moved, "path", "left").withColumn("change", change)
    columns = ["path", "filename", "length", "modificationTime", "digest", "change"]
    both = there.select(columns).unionByName(gone.withColumn("change", F.lit("gone")).select(columns))
    return both.withColumn("at", at.cast("timestamp"))

