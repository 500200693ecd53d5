"""Language identification by a byte convolutional network, in numpy.

Bytes are embedded, convolved with filters of several widths, the largest value of each
filter over a window of fixed length is kept, and a softmax turns these into languages. The
network is trained by Adam on windows of at most ``max_rows`` labelled documents. A document
is cut into windows over its whole text, however long; the windows' log probabilities,
weighted by how many bytes of letters they hold, are averaged.

Defined results: a null text, and one without any letter, is ``und`` with score 0; a null
language, or a document outside ``learn_from``, is not learned from; if nothing can be
learned from, everything is ``und``; ties go to the language first in alphabetical order;
repeated documents each get their row; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventrill.llm.common import in_arrow

WINDOW = 256  # bytes
WIDTHS = (2, 3, 4)
EMBEDDING = 8
FILTERS = 8  # of each width
MAX_ROWS = 6_000
TRAIN_WINDOWS = 2  # of each labelled document, from places spread over the text
EPOCHS = 4
BATCH_WINDOWS = 512
UNKNOWN = "und"

_PAD = WINDOW + max(WIDTHS) - 1
_BLOCK = 64  # windows whose sums stay in a core's cache


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)


# how much a byte says: letters and bytes of longer characters count, signs and digits do not
_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)], np.float32)


def windows(raw: np.ndarray) -> np.ndarray:
    """All windows of a text, one after another; the last is padded with zeros.

    A window also sees the first bytes of the next one, so that no word is cut in two.
    """
    n = max(1, -(-len(raw) // WINDOW))
    padded = np.zeros((n + 1) * WINDOW, np.uint8)
    padded[: len(raw)] = raw
    return np.lib.stride_tricks.as_strided(padded, (n, _PAD), (WINDOW, 1))


class ByteNet:
    def __init__(self, languages: list[str], seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.embedding = rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32)
        self.embedding[0] = 0
        self.kernels = [
            rng.normal(0, np.sqrt(2 / (w * EMBEDDING)), (w * EMBEDDING, FILTERS)).astype(np.float32) for w in WIDTHS
        ]
        self.biases = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        total = FILTERS * len(WIDTHS)
        self.out = rng.normal(0, np.sqrt(1 / total), (total, len(languages))).astype(np.float32)
        self.out_bias = np.zeros(len(languages), np.float32)

    def pooled(self, x: np.ndarray, keep: bool = False):
        """Largest filter values of each window, and where they were.

        All filters are laid into one of the greatest width, with zeros behind the shorter
        ones, so that one product gives them all.
        """
        n, widest = len(x), max(WIDTHS)
        joined = np.zeros((widest * EMBEDDING, FILTERS * len(WIDTHS)), np.float32)
        for j, (w, kernel) in enumerate(zip(WIDTHS, self.kernels)):
            joined[: w * EMBEDDING, j * FILTERS : (j + 1) * FILTERS] = kernel
        tops, where = [], []
        for at in range(0, n, _BLOCK):
            vectors = np.take(self.embedding, x[at : at + _BLOCK], axis=0).reshape(-1, x.shape[1] * EMBEDDING)
            shape = (len(vectors), WINDOW, widest * EMBEDDING)
            strides = (vectors.strides[0], 4 * EMBEDDING, 4)
            seen = np.lib.stride_tricks.as_strided(vectors, shape, strides).reshape(-1, shape[2])
            sums = (seen @ joined).reshape(len(vectors), WINDOW, -1)
            if keep:
                where.append(sums.argmax(axis=1))
                tops.append(np.take_along_axis(sums, where[-1][:, None, :], axis=1)[:, 0])
            else:
                tops.append(sums.max(axis=1))
        top = np.concatenate(tops) + np.concatenate(self.biases)
        return np.maximum(top, 0), np.concatenate(where) if keep else None

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        h, _ = self.pooled(x)
        z = h @ self.out + self.out_bias
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, batch: int = 64, seed: int = 6) -> None:
        rng = np.random.default_rng(seed)
        weights = [self.embedding, *self.kernels, *self.biases, self.out, self.out_bias]
        m, v, t = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        share = np.bincount(y, minlength=len(self.languages)) / len(y)
        weight = (1 / np.maximum(share * len(self.languages), 1e-6)).astype(np.float32)
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                grads = self._gradients(x[rows], y[rows], weight)
                t += 1
                rate = 0.01 * min(1.0, 4 * (1 - (t * batch) / (epochs * len(x) + batch)))
                for i, (w, g) in enumerate(zip(weights, grads)):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    w -= rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
                self.embedding[0] = 0

    def _gradients(self, x, y, weight):
        h, where = self.pooled(x, keep=True)
        z = h @ self.out + self.out_bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        p *= weight[y][:, None] / len(y)
        back = (p @ self.out.T) * (h > 0)
        g_embedding = np.zeros_like(self.embedding)
        g_kernels, g_biases = [], []
        for j, w in enumerate(WIDTHS):
            part = back[:, j * FILTERS : (j + 1) * FILTERS]
            # bytes under each filter at the place of its largest value
            seen = np.stack([np.take_along_axis(x, where[:, j * FILTERS : (j + 1) * FILTERS] + i, axis=1) for i in range(w)], axis=2)
            vectors = self.embedding[seen].reshape(len(x), FILTERS, w * EMBEDDING)
            g_kernels.append(np.einsum("nf,nfk->kf", part, vectors))
            g_biases.append(part.sum(axis=0))
            to_bytes = part[:, :, None] * self.kernels[j].T[None]
            np.add.at(g_embedding, seen.reshape(-1), to_bytes.reshape(-1, EMBEDDING))
        return [g_embedding, *g_kernels, *g_biases, h.T @ p, p.sum(axis=0)]


def fit(docs: DataFrame, learn_from: Column, max_rows: int = MAX_ROWS) -> ByteNet | None:
    """A network from at most ``max_rows`` documents with a language, chosen by the hash of their id."""
    usable = docs.where(F.col("lang").isNotNull() & (F.length("text") > 0) & learn_from)
    ids = usable.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    places = (F.length("text") - WINDOW) / TRAIN_WINDOWS
    cuts = F.array(*(
        F.substr("text", (1 + F.greatest(places * i, F.lit(0))).cast("int"), F.lit(WINDOW)) for i in range(TRAIN_WINDOWS)
    ))
    chosen = usable.join(F.broadcast(ids), "doc_id")  # max_rows rows at most
    rows = chosen.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", cuts.alias("cuts")).toLocalIterator()
    got = {}
    for r in sorted((r["doc_id"], r["lang"], r["cuts"]) for r in rows):
        got.setdefault(r[0], r[1:])
    if not got:
        return None
    languages = sorted({lang for lang, _ in got.values()})
    x, y = [], []
    for lang, texts in got.values():
        for text in dict.fromkeys(texts):
            x.append(windows(_bytes(text))[0])
            y.append(languages.index(lang))
    net = ByteNet(languages)
    net.train(np.array(x), np.array(y))
    return net


def _predict(net: ByteNet | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if net is None:
        return names, scores
    rows = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
    totals = {i: np.zeros(len(net.languages)) for i in rows}
    held, owners, n = [], [], 0

    def flush():
        x = np.concatenate(held)
        weight = _LETTER[x[:, :WINDOW]].sum(axis=1) + 1e-3
        logs = net.log_probabilities(x) * weight[:, None]
        at = 0
        for i, k in owners:
            # a sum over windows, later divided by the weights: kept as an average
            total, w = totals[i], weight[at : at + k]
            total += logs[at : at + k].sum(axis=0)
            sums[i] = sums.get(i, 0.0) + float(w.sum())
            at += k

    sums: dict[int, float] = {}
    for i in rows:
        cut = windows(_bytes(texts[i]))
        for at in range(0, len(cut), BATCH_WINDOWS):
            part = cut[at : at + BATCH_WINDOWS]
            held.append(part)
            owners.append((i, len(part)))
            n += len(part)
            if n >= BATCH_WINDOWS:
                flush()
                held, owners, n = [], [], 0
    if held:
        flush()
    for i in rows:
        mean = totals[i] / sums[i]
        p = np.exp(mean - mean.max())
        p /= p.sum()
        best = int(np.argmax(p))
        names[i], scores[i] = net.languages[best], float(p[best])
    return names, scores


def predict_language(docs: DataFrame, net: ByteNet | None) -> DataFrame:
    """Per document ``doc_id, lang_pred, score``."""

    def work(batches):
        for batch in batches:
            names, scores = _predict(net, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"]
            )

    ids = F.col("doc_id").cast("bigint").alias("doc_id")
    return in_arrow(docs.select(ids, "text"), work, "doc_id bigint, lang_pred string, score double")
