"""Quality classifier: random-indexing word vectors, pooled, and a small calibrated network.

Random indexing gives every word a sparse random index vector, drawn from its hash; a
word's vector is the sum of the index vectors of the words around it, over the whole
corpus. Words share ``BUCKETS`` rows by hash, so the table of vectors has a fixed size; it is
summed by one aggregate with a map-side part. Besides the word itself the stream holds its
shape (runs of upper case, lower case, digits and signs, and whether the word before was the
same), so that words never seen before have a known neighbour. A document is the mean
of its words' vectors and of its shapes' vectors.

On these features a network of two layers is trained in numpy, on the driver, from at most
``max_rows`` labelled documents; a temperature fitted on rows kept apart calibrates its
probabilities. The score of a document depends on its text alone.

Defined results: null and empty texts have the zero vector, and their score is what the
network says to it; a label that is null, or whose document is missing, is not learned
from; of contradicting labels of one document the smallest counts; without any usable
labels every score is 0.5; repeated documents each get their score; other columns are not
read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventrill.llm.common import in_arrow

BUCKETS = 8_192
DIMENSIONS = 48
NONZEROS = 4
REACH = 1  # words to either side
MAX_ROWS = 20_000  # labelled documents the network learns from
HIDDEN = 32
ADDED_CHARS = 3_000_000  # of texts whose words' neighbours are counted at a time
PIECE_WORDS = 65_536  # words that are pooled at a time

_SHAPE_BUCKETS = 512  # the first rows belong to shapes
_SHAPE_RUNS = 8  # runs of a word's shape that count

_SPACE = np.array([b in b" \t\n\x0b\x0c\r" for b in range(256)])
# 0: part of a longer character, which may be of either case; 1-3: letters and digits; signs stand for themselves
_CLASS = np.array(
    [0 if b >= 128 else 1 if 65 <= b <= 90 else 2 if 97 <= b <= 122 else 3 if 48 <= b <= 57 else b + 4 for b in range(256)],
    np.int64,
)
_random = np.random.default_rng(17)
_BYTE_CODES = _random.integers(1, 2**63, 256, dtype=np.uint64)
_PLACE_CODES = _random.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_AGAIN = np.uint64(0x5851F42D4C957F2D)  # any number does


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x *= np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def _sums(codes: np.ndarray, starts: np.ndarray, cut: int | None = None) -> np.ndarray:
    """Hash of each run of codes that begins at ``starts``, by codes and places (of the first ``cut``)."""
    place = np.arange(len(codes)) - np.repeat(starts, np.diff(np.r_[starts, len(codes)]))
    parts = _BYTE_CODES[codes] * _PLACE_CODES[place & 63]
    if cut:
        parts[place >= cut] = 0
    return np.add.reduceat(parts, starts)


def token_rows(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the words of all texts, rows of their shapes, and the number of each word's text.

    A word is what stands between white space. Its shape is its runs of upper case, lower
    case, digits and equal signs, and whether the word before is the same.
    """
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    row = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    inside = np.nonzero(~_SPACE[row])[0]
    if len(inside) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    starts = np.nonzero(np.r_[True, np.diff(inside) != 1])[0]
    begins = np.cumsum([0, *(len(r) + 1 for r in raw)])
    text = np.searchsorted(begins, inside[starts], side="right") - 1
    body = row[inside]
    words = _mixed(_sums(body, starts))

    kinds = _CLASS[body]
    told = np.nonzero(kinds)[0]
    kinds, owner = kinds[told], np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(body)]))[told]
    new = np.r_[True, (kinds[1:] != kinds[:-1]) | (owner[1:] != owner[:-1])][: len(kinds)]
    kinds, owner = kinds[new], owner[new]
    shapes = np.zeros(len(words), np.uint64)
    if len(kinds):
        first = np.nonzero(np.r_[True, owner[1:] != owner[:-1]])[0]
        shapes[owner[first]] = _sums(kinds, first, _SHAPE_RUNS)
    again = np.r_[False, (words[1:] == words[:-1]) & (text[1:] == text[:-1])]
    shapes[again] ^= _AGAIN
    rows = (words % np.uint64(BUCKETS - _SHAPE_BUCKETS)).astype(np.int64) + _SHAPE_BUCKETS
    return rows, (_mixed(shapes) % np.uint64(_SHAPE_BUCKETS)).astype(np.int64), text


def index_vectors(seed: int = 7) -> np.ndarray:
    """``BUCKETS`` sparse vectors of +1 and -1, the same on every machine."""
    rng = np.random.default_rng(seed)
    at = np.argsort(rng.random((BUCKETS, DIMENSIONS)), axis=1)[:, :NONZEROS]
    out = np.zeros((BUCKETS, DIMENSIONS), np.int8)
    np.put_along_axis(out, at, rng.choice(np.array([-1, 1], np.int8), at.shape), axis=1)
    return out


def _neighbour_counts(docs: DataFrame) -> DataFrame:
    """``row, d0, d1, ...``: for each row the summed index vectors of its neighbours."""
    names = [f"d{i}" for i in range(DIMENSIONS)]
    schema = pa.schema([("row", pa.int32()), *((n, pa.int64()) for n in names)])

    def work(batches):
        index = index_vectors()
        cells = BUCKETS * DIMENSIONS
        total = np.zeros(cells, np.int64)
        # (dimension, sign) of each row's non-zeros, to add without touching zeros
        at = np.argsort(index == 0, axis=1, kind="stable")[:, :NONZEROS]
        sign = np.take_along_axis(index, at, axis=1)

        def add(centre, beside):
            base = centre.astype(np.int64) * DIMENSIONS
            for k in range(NONZEROS):
                cell, up = base + at[beside, k], sign[beside, k] > 0
                np.add(total, np.bincount(cell[up], minlength=cells), out=total)
                np.subtract(total, np.bincount(cell[~up], minlength=cells), out=total)

        def add_all(texts):
            word, kind, text = token_rows(texts)
            for reach in range(1, REACH + 1):
                both = text[reach:] == text[:-reach]
                for rows in (word, kind):
                    left, right = rows[:-reach][both], rows[reach:][both]
                    add(left, right)
                    add(right, left)
            add(word, kind)

        held, n = [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    held.append(text)
                    n += len(text)
                if n >= ADDED_CHARS:
                    add_all(held)
                    held, n = [], 0
        if held:
            add_all(held)
        total = total.reshape(BUCKETS, DIMENSIONS)
        rows = np.nonzero(total.any(axis=1))[0]
        columns = [pa.array(rows, pa.int32()), *(pa.array(total[rows, i]) for i in range(DIMENSIONS))]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    partial = in_arrow(docs.select("text"), work, f"row int, {', '.join(n + ' bigint' for n in names)}")
    return partial.groupBy("row").agg(*(F.sum(n).alias(n) for n in names))


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The table of vectors: ``BUCKETS`` rows of unit length, whatever the size of the corpus."""
    table = np.zeros((BUCKETS, DIMENSIONS))
    for r in _neighbour_counts(docs).toLocalIterator():
        table[r[0]] = r[1:]
    table = np.sign(table) * np.sqrt(np.abs(table))  # frequent neighbours do not drown the rest
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    context = np.divide(table, norm, out=np.zeros_like(table), where=norm > 0)
    return (context + index_vectors() / np.sqrt(NONZEROS)).astype(np.float32)


def pooled(texts: list[str | None], vectors: np.ndarray) -> np.ndarray:
    """Per text, the mean of its words' vectors and the mean of its shapes' vectors."""
    out = np.zeros((len(texts), 2 * DIMENSIONS), np.float32)
    held, n, first = [], 0, 0
    for i, t in enumerate(texts):
        held.append(t)
        n += len(t or "")
        if n >= ADDED_CHARS or i == len(texts) - 1:
            word, kind, text = token_rows(held)
            for at in range(0, len(text), PIECE_WORDS):
                some = text[at : at + PIECE_WORDS]
                starts = np.nonzero(np.r_[True, some[1:] != some[:-1]])[0]
                for side, rows in enumerate((word, kind)):
                    sums = np.add.reduceat(vectors[rows[at : at + PIECE_WORDS]], starts, axis=0)
                    out[first + some[starts], side * DIMENSIONS : (side + 1) * DIMENSIONS] += sums
            counts = np.bincount(text, minlength=len(held))
            out[first : i + 1] /= np.maximum(counts, 1)[:, None]
            held, n, first = [], 0, i + 1
    return out


class Network:
    """One hidden layer of rectified units and a logistic output, with a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 11, epochs: int = 120, batch: int = 128) -> None:
        """Learns by Adam; one row in five, by position, is kept apart for the temperature."""
        self.temperature, self._constant = 1.0, None
        if len(set(y.tolist())) < 2:
            self._constant = 0.5 if len(y) == 0 else float(np.clip(y[0], 0.02, 0.98))
            return
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - self.mean) / self.scale
        apart = np.arange(len(x)) % 5 == 4
        if len(set(y[apart].tolist())) < 2:
            apart[:] = False
        tx, ty = x[~apart], y[~apart]
        w = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
             rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
        m, v, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
        weight = np.where(ty == 1, 0.5 / max(ty.mean(), 1e-9), 0.5 / max(1 - ty.mean(), 1e-9))
        epochs = max(20, min(epochs, 3_000_000 // len(tx)))
        for _ in range(epochs):
            order = rng.permutation(len(tx))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                h = np.maximum(tx[rows] @ w[0] + w[1], 0)
                error = (1 / (1 + np.exp(-(h @ w[2] + w[3]))) - ty[rows]) * weight[rows] / len(rows)
                back = np.outer(error, w[2]) * (h > 0)
                grads = [tx[rows].T @ back + 1e-4 * w[0], back.sum(0), h.T @ error + 1e-4 * w[2], error.sum(keepdims=True)]
                t += 1
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    w[i] = w[i] - 0.003 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
        self.weights = w
        if apart.any():
            z, hy = self._logit(x[apart]), y[apart]
            grid = np.geomspace(0.5, 8, 61)
            losses = [np.mean(np.logaddexp(0, z / g) - hy * z / g) for g in grid]
            self.temperature = float(grid[int(np.argmin(losses))])

    def _logit(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.maximum(x @ w[0] + w[1], 0) @ w[2] + w[3]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self._constant is not None:
            return np.full(len(x), self._constant)
        return 1 / (1 + np.exp(-np.clip(self._logit((x - self.mean) / self.scale) / self.temperature, -30, 30)))


def training_rows(docs: DataFrame, labels: DataFrame, learn_from: Column, max_rows: int = MAX_ROWS) -> DataFrame:
    """``doc_id, text, y``: at most ``max_rows`` labelled documents, chosen by the hash of their id."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & learn_from)
    # ids are unique after this, and the order is a hash: the choice does not depend on the label
    chosen = usable.groupBy("doc_id").agg(F.min("quality").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # max_rows rows at most


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column, max_rows: int = MAX_ROWS) -> tuple[np.ndarray, Network]:
    """Vectors from all ``docs``, and a network from labelled rows that satisfy ``learn_from``."""
    vectors = word_vectors(docs)

    def features(batches):
        for batch in batches:
            x = [v.tobytes() for v in pooled(batch.column(1).to_pylist(), vectors)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(x, pa.binary())], ["doc_id", "y", "x"]
            )

    rows = training_rows(docs, labels, learn_from, max_rows)
    rows = in_arrow(rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.col("y").cast("int").alias("y")),
                    features, "doc_id bigint, y int, x binary")
    # a document whose id is repeated has as many rows; the first text, in order, counts
    got = {}
    for r in sorted(rows.toLocalIterator(), key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"], bytes(r["x"]))):
        got.setdefault(r["doc_id"], (r["y"], r["x"]))
    x = np.array([np.frombuffer(b, np.float32) for _, b in got.values()], np.float64).reshape(-1, 2 * DIMENSIONS)
    return vectors, Network(x, np.array([y for y, _ in got.values()], np.float64))


def score_quality(docs: DataFrame, model: tuple[np.ndarray, Network]) -> DataFrame:
    """Per document ``doc_id, score``."""
    vectors, network = model

    def work(batches):
        for batch in batches:
            s = network.scores(pooled(batch.column(1).to_pylist(), vectors).astype(np.float64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    return in_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), work, "doc_id bigint, score double")


def keep_good(docs: DataFrame, model: tuple[np.ndarray, Network], threshold: float = 0.3) -> DataFrame:
    """``docs``, all columns as they were, without those that score below ``threshold``."""
    at, (vectors, network) = docs.columns.index("text"), model

    def work(batches):
        for batch in batches:
            s = network.scores(pooled(batch.column(at).to_pylist(), vectors).astype(np.float64))
            yield batch.filter(pa.array(s >= threshold, pa.bool_()))

    return in_arrow(docs, work, docs.schema)
