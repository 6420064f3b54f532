"""Landing by content: what is opened, and what each change is called."""

import hashlib
import os

from pyspark.sql import functions as F

from vialens.plans import medallion
from vialens.sources import ledger, readers


def root(data, chunk):
    leaves = [hashlib.sha256(data[i : i + chunk]).digest() for i in range(0, len(data), chunk)]
    return hashlib.sha256(b"".join(leaves)).hexdigest()


def test_digests_over_chunks(spark, tmp_path):
    bodies = {"a": b"x" * 1000, "b": os.urandom(777), "c": b"y", "d": b"x" * 1000}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    files = readers.file_listing(spark, str(tmp_path))
    for chunk in (64, 10**6):
        got = {r.path.rsplit("/", 1)[1]: r.digest for r in ledger.digests(files, chunk).collect()}
        assert got == {n: root(b, chunk) for n, b in bodies.items()}


def landed(spark, lake):
    return sorted(r.filename for r in lake.read(spark, "landed_changes").collect())


def run(spark, lake, source, n):
    entries = medallion.land_changed(spark, lake, str(source), F.lit("2026-01-01").cast("date"), F.lit(f"2026-01-01 00:00:0{n}"))
    return sorted((r.filename, r.change) for r in entries.collect())


def test_only_changes_are_opened_and_landed(spark, tmp_path):
    source, lake = tmp_path / "in", medallion.Lake(str(tmp_path / "lake"))
    source.mkdir()
    for name in "abcde":
        (source / name).write_text(f"content of {name}" if name != "e" else "content of d")
    assert run(spark, lake, source, 1) == [(n, "new") for n in "abcde"]
    assert landed(spark, lake) == list("abcde")
    # nothing changed: a file that other bytes stand in, at the same length and time, shows it is not opened
    stat = (source / "a").stat()
    (source / "a").write_text("CONTENT OF A")
    os.utime(source / "a", ns=(stat.st_atime_ns, stat.st_mtime_ns))
    assert run(spark, lake, source, 2) == []
    later = stat.st_mtime_ns + 5 * 10**9
    (source / "b").write_text("another content")
    os.utime(source / "b", ns=(later, later))
    os.utime(source / "c", ns=(later, later))
    (source / "d").rename(source / "z")
    os.utime(source / "z", ns=(later, later))
    (source / "n").write_text("content of d")  # a third of one content: one took the old place, one is new
    assert run(spark, lake, source, 3) == [("b", "changed"), ("c", "touched"), ("d", "gone"), ("n", "renamed"), ("z", "new")]
    assert landed(spark, lake) == ["a", "b", "b", "c", "d", "e", "z"]
    assert run(spark, lake, source, 4) == []
    now = {r.filename for r in ledger.current(lake.read(spark, "ledger")).collect()}
    assert now == set("abceznz")
    # a path that comes back
    (source / "d").write_text("content of d, again")
    assert run(spark, lake, source, 5) == [("d", "new")]


def test_first_run_and_a_new_set_of_files(spark, tmp_path):
    source, lake = tmp_path / "in", medallion.Lake(str(tmp_path / "lake"))
    source.mkdir()
    (source / "only").write_text("0")
    assert run(spark, lake, source, 1) == [("only", "new")]
    (source / "only").unlink()
    (source / "next").write_text("1")
    assert run(spark, lake, source, 2) == [("next", "new"), ("only", "gone")]
