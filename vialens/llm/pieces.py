"""SentencePiece encoding that keeps, for every piece, its span of original bytes.

``CharacterMap`` reads the compiled character map of a model: a double-array
trie of source strings, then their replacements. Normalising takes the longest
entry that starts at the cursor, or else one character, and records for every
normalised byte where it came from. Pieces lie end to end over the normalised
text, so their lengths give places in it, and the record turns these into
spans of the original.

Encoding runs by units where the model allows it (no character map, white
space kept, no piece that holds a space after another character): merges then
never cross from a word into the space after it, and each distinct unit is
encoded once. Other models, and texts that hold the space mark itself, are
encoded as whole documents.
"""

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vialens.llm.bytewords import Chunk, bounds, ragged, text_chunks
from vialens.llm.units import Units, worker_state

MARK = "▁"
_MARK = MARK.encode()
_REPLACEMENT = "�".encode()


class CharacterMap:
    """A compiled character map: ``longest`` gives (bytes taken, their replacement)."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.nodes = np.frombuffer(blob[4 : 4 + size], "<u4").tolist() if blob else []
        self.replacements = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes]:
        taken, found, nodes = 0, 0, self.nodes
        if nodes:
            place = _offset(nodes[0])
            for i in range(at, len(text)):
                place ^= text[i]
                if place >= len(nodes) or nodes[place] & 0x800000FF != text[i]:
                    break
                node = nodes[place]
                place ^= _offset(node)
                if node >> 8 & 1:
                    taken, found = i + 1 - at, nodes[place] & 0x7FFFFFFF
        if taken:
            return taken, self.replacements[found : self.replacements.index(b"\0", found)]
        n = _character(text, at)
        return (n, text[at : at + n]) if n else (1, _REPLACEMENT)


def _offset(node: int) -> int:
    return (node >> 10) << ((node & 0x200) >> 6)


def _character(text: bytes, at: int) -> int:
    """Bytes of the character at ``at``; 0 if they are no valid UTF-8."""
    n = next((n for n, top in ((1, 0x80), (2, 0xE0), (3, 0xF0), (4, 0xF8)) if text[at] < top), 0)
    try:
        return n if len(text[at : at + n].decode()) == 1 else 0
    except UnicodeDecodeError:
        return 0


class Normaliser:
    """A model's normalisation with the source of every normalised byte."""

    def __init__(self, spec, suffix: bool, whole: list[bytes]):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.trim, self.prefix = spec.remove_extra_whitespaces, spec.add_dummy_prefix
        self.space = _MARK if spec.escape_whitespaces else b" "
        self.suffix = suffix
        self.whole = sorted(whole, key=len, reverse=True)

    def _next(self, text: bytes, at: int) -> tuple[int, bytes]:
        for symbol in self.whole:
            if text.startswith(symbol, at):
                return len(symbol), symbol
        return self.map.longest(text, at)

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """(normalised bytes, source offset of each and of the end)."""
        out, source, at = bytearray(), [], 0
        if self.trim:
            while at < len(text):
                n, new = self._next(text, at)
                if new != b" ":
                    break
                at += n
        if at == len(text):
            return b"", np.array([0])
        if self.prefix and not self.suffix:
            out += self.space
            source += [at] * len(self.space)
        after_space = self.trim
        while at < len(text):
            n, new = self._next(text, at)
            if after_space:
                new = new.lstrip(b" ")
            if new:
                after_space = self.trim and new.endswith(b" ")
                new = new.replace(b" ", self.space)
                out += new
                source += [at] * len(new)
            at += n
        if self.trim:
            while out.endswith(self.space):
                at = source[len(out) - len(self.space)]
                del out[-len(self.space) :], source[-len(self.space) :]
        if self.prefix and self.suffix:
            out += self.space
            source += [at] * len(self.space)
        return bytes(out), np.array([*source, at])


class Pieces:
    """A SentencePiece model whose encoding carries spans."""

    def __init__(self, path: str | None = None, proto: bytes | None = None):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        if proto is None:
            with open(path, "rb") as f:
                proto = f.read()
        self.library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(proto)
        spec, suffix = model.normalizer_spec, model.trainer_spec.treat_whitespace_as_suffix
        symbols = [p.piece for p in model.pieces if p.type == p.USER_DEFINED]
        self.normalise = Normaliser(spec, suffix, [s.encode() for s in symbols])
        self.is_byte = np.array([p.type == p.BYTE for p in model.pieces])
        self.by_units = (
            not spec.precompiled_charsmap
            and spec.add_dummy_prefix
            and spec.escape_whitespaces
            and not spec.remove_extra_whitespaces
            and not suffix
            and not symbols
            and model.trainer_spec.model_type == model.trainer_spec.BPE
            and model.trainer_spec.byte_fallback
            and not any(MARK in p.piece.lstrip(MARK) for p in model.pieces)
        )
        #: Source bytes of each piece, a space mark counting one.
        self.bytes_of = np.array(
            [1 if p.type == p.BYTE else len(p.piece.replace(MARK, " ").encode()) for p in model.pieces]
        )
        self.units = Units(self._contents)
        mark = np.array(self.library.encode("a ")[len(self.library.encode("a")) :], "<u4")
        self.mark = mark.tobytes()

    def _contents(self, contents: list[bytes]) -> list[bytes]:
        # the library puts the leading space back; of an empty text it would make nothing
        texts = [(c[1:] if c[:1] == b" " else c).decode() for c in contents]
        found = self.library.encode(texts, num_threads=1)
        return [np.array(ids, "<u4").tobytes() if t else self.mark for ids, t in zip(found, texts, strict=True)]

    def encode(self, chunk: Chunk):
        """(ids of all documents, ids of each, begins, ends): spans in bytes of the document."""
        data, n = chunk.data, int(chunk.offsets[-1])
        marked = np.flatnonzero(
            (data[:n] == _MARK[0]) & (data[1 : n + 1] == _MARK[1]) & (data[2 : n + 2] == _MARK[2])
        )
        whole = np.zeros(chunk.n, bool)
        whole[np.searchsorted(chunk.offsets, marked, "right") - 1] = True
        if not self.by_units or whole.all():
            return self._join([self.encode_one(chunk.text(i)) for i in range(chunk.n)])
        begins = np.zeros(n + 1, bool)
        if n:
            begins[1:n] = (data[1:n] == 0x20) & (data[: n - 1] != 0x20)
        begins[chunk.offsets] = True
        begins[n] = False
        starts = np.flatnonzero(begins)
        lengths = np.diff(np.append(starts, n))
        document = np.searchsorted(chunk.offsets, starts, "right") - 1
        opening = np.zeros(n + 1, bool)
        opening[chunk.offsets[:-1]] = True
        opening = opening[starts]
        # a document's first unit has no space of its own before it, all others have
        ids, counts = self.units.ids_of(*_opened(chunk, starts, lengths, opening))
        per_document = np.bincount(document, counts, chunk.n).astype(np.int64)
        sizes = self.bytes_of[ids]
        at = bounds(per_document)
        first = at[:-1][per_document > 0]
        sizes[first] -= 1  # the prefix stands for no byte
        total = bounds(sizes)
        ends = total[1:] - np.repeat(total[at[:-1]], per_document)
        parts = ids, per_document, ends - sizes, ends
        if not whole.any():
            return parts
        split = [tuple(p[at[i] : at[i + 1]] for p in (ids, parts[2], parts[3])) for i in range(chunk.n)]
        for i in np.flatnonzero(whole):
            split[i] = self.encode_one(chunk.text(i))
        return self._join(split)

    def encode_one(self, text: bytes):
        """(ids, begins, ends) of a whole document."""
        ids = np.array(self.library.encode(text.decode()), np.uint32)
        pieces = self.library.encode_as_pieces(text.decode())
        normal, source = self.normalise(text)
        sizes = [
            1 if self.is_byte[i] else len(p.encode()) for i, p in zip(ids.tolist(), pieces, strict=True)
        ]
        at = bounds(np.array(sizes, np.int64))
        if at[-1] != len(normal):
            raise ValueError("the pieces do not cover the normalised text")
        return ids, source[at[:-1]], source[at[1:]]

    @staticmethod
    def _join(parts):
        ids, begins, ends = (np.concatenate(x) if x else np.zeros(0, int) for x in zip(*parts, strict=True))
        return ids, np.array([len(p[0]) for p in parts], np.int64), begins, ends


def _opened(chunk: Chunk, starts, lengths, opening):
    """The chunk with a space before every document, and the units that then all start with one."""
    added = np.cumsum(opening)
    sizes = np.diff(chunk.offsets)
    shift = bounds((sizes > 0).astype(np.int64))
    n = int(chunk.offsets[-1])
    data = np.full(n + int(shift[-1]) + 8, 0x20, np.uint8)
    data[-8:] = 0
    data[ragged(chunk.offsets[:-1] + shift[1:], sizes)] = chunk.data[:n]
    return (
        Chunk(chunk.first, chunk.n, data, chunk.offsets + shift),
        starts + added - opening,
        lengths + opening,
    )


def _loaded(path: str) -> Pieces:
    return worker_state(f"pieces:{path}", lambda: Pieces(path))


def encode_documents(
    docs: DataFrame,
    model: str,
    id: str = "doc_id",
    text: str = "text",
    spans: bool = True,
    digest: bool = False,
) -> DataFrame:
    """(doc_id, ids, begins, ends): the ids of every document and each piece's span of bytes.

    Null and empty texts have no ids. A span covers the source bytes of its
    piece in UTF-8; the pieces of a byte-fallback character split its bytes.
    ``spans=False`` leaves the spans out. ``digest`` adds decoded_sha256, the
    digest of what the ids decode to.
    """
    names = ["doc_id", "ids"] + ["begins", "ends"] * spans + ["decoded_sha256"] * digest

    def encode(batches: Iterator[pa.RecordBatch]):
        pieces = _loaded(model)
        for batch in batches:
            for chunk in text_chunks(batch.column(1)):
                ids, counts, begins, ends = pieces.encode(chunk)
                at = pa.array(bounds(counts), pa.int32())
                parts = (ids, begins, ends) if spans else (ids,)
                lists = [pa.ListArray.from_arrays(at, pa.array(c, pa.int32())) for c in parts]
                keys = batch.column(0).slice(chunk.first, chunk.n)
                if digest:
                    decoded = (ids[a:b].tolist() for a, b in pairwise(bounds(counts).tolist()))
                    decoded = (pieces.library.decode(x) if x else "" for x in decoded)
                    lists.append(pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded], pa.string()))
                yield pa.RecordBatch.from_arrays([keys, *lists], names)

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, ids array<int>" + ", begins array<int>, ends array<int>" * spans
    return rows.mapInArrow(encode, schema + ", decoded_sha256 string" * digest)


def decode_ids(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the library's text of each row's ids; null ids are none."""

    def decode(batches: Iterator[pa.RecordBatch]):
        pieces = _loaded(model)
        for batch in batches:
            lists = [x or [] for x in batch.column(ids).to_pylist()]
            texts = pieces.library.decode(lists, num_threads=1) if lists else []
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(decode, f"{fields}, decoded string")


_DIGESTS = (
    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long, n_spans long"
)


def _decimals(pieces: Pieces):
    """The ids' decimals, each followed by a comma, one after the other."""
    texts = [b"%d," % i for i in range(len(pieces.bytes_of))]
    sizes = np.array([len(t) for t in texts])
    return np.frombuffer(b"".join(texts), np.uint8), bounds(sizes)[:-1], sizes


def piece_digests(docs: DataFrame, model: str) -> DataFrame:
    """Per document: number of tokens, digests of the ids and of what they decode to.

    ``n_bytes`` is where the last span ends, ``n_spans`` how many spans hold a byte.
    """

    def digest(batches: Iterator[pa.RecordBatch]):
        pieces = _loaded(model)
        digits, digit_at, digit_n = worker_state(f"decimals:{model}", lambda: _decimals(pieces))
        for batch in batches:
            for chunk in text_chunks(batch.column(1)):
                ids, counts, begins, ends = pieces.encode(chunk)
                at = bounds(counts).tolist()
                lists = ids.tolist()
                lists = [lists[a:b] for a, b in pairwise(at)]
                decoded = pieces.library.decode(lists, num_threads=1)
                sizes = digit_n[ids]
                written = digits[ragged(digit_at[ids], sizes)].tobytes()
                places = bounds(sizes)[np.array(at)].tolist()
                held = bounds((ends > begins).astype(np.int64))[np.array(at)]
                last = np.zeros(chunk.n, np.int64)
                last[counts > 0] = ends[np.array(at[1:])[counts > 0] - 1]
                columns = [
                    batch.column(0).slice(chunk.first, chunk.n),
                    pa.array(counts, pa.int64()),
                    [hashlib.sha256(written[a : max(a, b - 1)]).hexdigest() for a, b in pairwise(places)],
                    [hashlib.sha256(t.encode()).hexdigest() for t in decoded],
                    pa.array(last, pa.int64()),
                    pa.array(np.diff(held), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) if isinstance(c, list) else c for c in columns],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", "n_spans"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(digest, _DIGESTS)
