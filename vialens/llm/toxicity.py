"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word's vector is the mean of the vectors of its byte n-grams and of itself,
all by hash into a fixed table, so misspellings and unseen endings share most
of a known word's vector. A run of ``window`` words has the mean of its words'
vectors, and a text is as toxic as its most toxic run: a mean over a long text
would drown a few words. Runs first inherit the label of their text; further
rounds keep the label only for runs that the last round found toxic, and for
the most toxic run of each toxic text.

Training takes at most ``max_rows`` labelled rows of at most ``max_chars``
characters (the first by a hash of the id): both bound the one task that fits.
Scoring covers every text whole. Texts without a word, empty or null, have the
score of the bias alone. Rows keep their ids, repeated ones too.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vialens.llm.bytewords import LOWER, bounds, mix, ragged, span_hashes, text_chunks, word_spans

#: Letters and digits, and all bytes outside ASCII.
_SEPARATORS = np.zeros(256, bool)
_SEPARATORS[:0x30] = _SEPARATORS[0x3A:0x61] = _SEPARATORS[0x7B:0x80] = True

_NGRAMS = range(3, 7)
_SCALE = 10.0


@dataclass(frozen=True)
class Config:
    """``max_rows`` and ``max_chars`` bound the sample, ``buckets`` and ``dimensions`` the model.

    ``floor`` mutes what only a few runs of the sample tell, however large it is.
    """

    buckets: int = 1 << 18
    dimensions: int = 8
    window: int = 4
    max_rows: int = 6000
    max_chars: int = 20_000
    rounds: int = 3
    steps: int = 25
    rate: float = 0.05
    decay: float = 1.5
    floor: float = 0.6


@dataclass(frozen=True)
class Model:
    """What the two layers come to for two classes: a weight by bucket, and a bias."""

    weights: np.ndarray
    bias: float
    window: int


def _subwords(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, buckets: int):
    """(bucket of every subword, number of subwords of each word)."""
    room = lengths + 2
    at = bounds(room)[:-1]
    text = np.zeros(int(room.sum()) + 8, np.uint8)
    text[at] = ord("<")
    text[at + room - 1] = ord(">")
    text[ragged(at + 1, lengths)] = data[ragged(starts, lengths)]
    parts = [span_hashes(data, starts, lengths, 11)]
    owner = [np.arange(len(starts))]
    words = np.ndarray((len(text) - 7,), "<u8", text, 0, (1,))
    for n in _NGRAMS:
        count = np.maximum(room - n + 1, 0)
        place = ragged(at, count)
        gram = words[place] & np.uint64((1 << 8 * n) - 1)
        parts.append(mix(gram, np.full(len(gram), n, np.uint64)))
        owner.append(np.repeat(np.arange(len(starts)), count))
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    found = (np.concatenate(parts) % np.uint64(buckets)).astype(np.int64)
    return found[order], np.bincount(owner, minlength=len(starts))


def _distinct_words(chunk):
    starts, lengths, document = word_spans(chunk, _SEPARATORS)
    hashes = span_hashes(chunk.data, starts, lengths)
    distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    return distinct, starts[first], lengths[first], which, document


def _runs(document: np.ndarray, n_documents: int, window: int):
    """(run of every word, words of each run, document of each run); runs do not overlap."""
    n = np.bincount(document, minlength=n_documents)
    at = np.arange(len(document)) - bounds(n)[document]
    count = -(-n // window)
    run = bounds(count)[document] + at // window
    return run, np.bincount(run, minlength=int(count.sum())), np.repeat(np.arange(n_documents), count)


class _Adam:
    def __init__(self, like, floor: float):
        self.floor = floor
        self.mean, self.square, self.step = np.zeros_like(like), np.zeros_like(like), 0

    def __call__(self, slope):
        self.step += 1
        self.mean += 0.1 * (slope - self.mean)
        self.square += 0.01 * (slope * slope - self.square)
        mean, square = self.mean / (1 - 0.9**self.step), self.square / (1 - 0.99**self.step)
        return mean / (np.sqrt(square) + self.floor)


def fit(texts: pa.Array, toxic: np.ndarray, config: Config = Config()) -> Model:
    """Both layers by full-batch gradient steps; the same rows always give the same model."""
    number: dict[int, int] = {}
    subwords, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    words, documents = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for chunk in text_chunks(texts, LOWER):
        distinct, starts, lengths, which, document = _distinct_words(chunk)
        keys = distinct.tolist()
        new = np.array([i for i, h in enumerate(keys) if h not in number], np.int64)
        found, counts = _subwords(chunk.data, starts[new], lengths[new], config.buckets)
        number.update(zip(distinct[new].tolist(), range(len(number), len(number) + len(new))))
        subwords.append(found)
        sizes.append(counts)
        words.append(np.array([number[h] for h in keys], np.int64)[which])
        documents.append(document + chunk.first)
    subword, size = np.concatenate(subwords), np.concatenate(sizes)
    word, document = np.concatenate(words), np.concatenate(documents)
    n_words, owner = len(number), np.repeat(np.arange(len(size)), size)
    run, in_run, of = _runs(document, len(toxic), config.window)
    share, n_runs = (1 / np.maximum(in_run, 1))[run], len(in_run)

    random = np.random.default_rng(0)
    table = random.normal(0, 0.001, (config.buckets, config.dimensions)).astype(np.float32)
    layer = random.choice([-1.0, 1.0], config.dimensions)
    label = toxic[of].astype(float)
    bias = float(np.log((label.sum() + 1) / (n_runs - label.sum() + 1)))
    for _ in range(config.rounds if n_runs else 0):
        moves = [_Adam(x, config.floor / n_runs) for x in (table, layer, np.zeros(1))]
        for step in range(config.steps):
            rate = config.rate * (1 - step / config.steps)
            by_word = np.bincount(owner, (table @ layer)[subword], n_words) / size
            z = bias + _SCALE * np.bincount(run, share * by_word[word], n_runs)
            error = (_sigmoid(z) - label) / n_runs
            on_word = _SCALE * np.bincount(word, share * error[run], n_words) / size
            on_bucket = np.bincount(subword, on_word[owner], config.buckets)
            slopes = np.outer(on_bucket, layer).astype(np.float32), table.T @ on_bucket
            table *= np.float32(1 - rate * config.decay)
            table -= np.float32(rate) * moves[0](slopes[0])
            layer = layer - rate * moves[1](slopes[1])
            bias -= rate * float(moves[2](np.array([error.sum()]))[0])
        worst = np.full(len(toxic), -np.inf)
        np.maximum.at(worst, of, z)
        label = ((toxic[of] > 0) & ((z > 0) | (z >= worst[of]))).astype(float)
    return Model((table @ layer).astype(np.float32), bias, config.window)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score_texts(texts: pa.Array, model: Model) -> np.ndarray:
    """The score, 0 to 1, of every text."""
    out = []
    for chunk in text_chunks(texts, LOWER):
        _, starts, lengths, which, document = _distinct_words(chunk)
        found, counts = _subwords(chunk.data, starts, lengths, len(model.weights))
        owner = np.repeat(np.arange(len(counts)), counts)
        by_word = np.bincount(owner, model.weights[found], len(counts)) / counts
        run, in_run, of = _runs(document, chunk.n, model.window)
        z = _SCALE * np.bincount(run, by_word[which], len(in_run)) / np.maximum(in_run, 1)
        worst = np.full(chunk.n, -np.inf)
        np.maximum.at(worst, of, z)
        out.append(_sigmoid(model.bias + np.where(np.isinf(worst), 0, worst)))
    return np.concatenate(out) if out else np.zeros(0)


def held_out(id: str = "doc_id", folds: int = 5) -> Column:
    """Rows that training never sees: crc32 of the id as text divides by ``folds``."""
    return F.crc32(F.col(id).cast("string").cast("binary")) % folds == 0


def train(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
    config: Config = Config(), folds: int = 5,
) -> Model:
    """A model of the labelled rows outside the held-out fold.

    Rows without a text, id or label are not used. The sample is bounded by
    ``config``, so it is fitted in one task and the model comes to the driver.
    Without any row to learn from, every text scores 0.25.
    """
    marks = labels.select(F.col(id).alias("doc_id"), F.col(label).alias("toxic")).dropna()
    marks = marks.groupBy("doc_id").agg((F.max("toxic") > 0).cast("double").alias("toxic"))
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).dropna()
    usable = rows.filter((F.length("text") <= config.max_chars) & ~held_out("doc_id", folds))
    # ids are chosen before any text moves; max_rows of them at most
    chosen = usable.select("doc_id").distinct().join(marks, "doc_id")
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(config.max_rows)
    sample = usable.join(F.broadcast(chosen), "doc_id").limit(config.max_rows)
    sample = sample.select("text", "toxic").coalesce(1).sortWithinPartitions("text", "toxic")

    def fitted(batches: Iterator[pa.RecordBatch]):
        read = [b for b in batches if b.num_rows]
        texts = pa.concat_arrays([b.column(0) for b in read]) if read else pa.array([], pa.string())
        toxic = np.concatenate([np.zeros(0), *(b.column(1).to_numpy() for b in read)])
        model = fit(texts, toxic, config)
        yield pa.RecordBatch.from_pydict({"weights": [model.weights.tobytes()], "bias": [model.bias]})

    row = sample.mapInArrow(fitted, "weights binary, bias double").first()
    if row is None:
        return Model(np.zeros(config.buckets, np.float32), -float(np.log(3)), config.window)
    return Model(np.frombuffer(row["weights"], np.float32), row["bias"], config.window)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text."""
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)  # a table of fixed size
    at, bias, window = docs.columns.index(text), model.bias, model.window

    def scored(batches: Iterator[pa.RecordBatch]):
        own = Model(weights.value, bias, window)
        for batch in batches:
            found = pa.array(score_texts(batch.column(at), own), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, name])

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(scored, schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, by a model of ``labels``."""
    model = train(docs, labels)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
