"""Runs of words that repeat with a period, found on sparse diagonals of a text against itself.

The diagonal of lag ``q`` holds, at word ``i``, how many words up to ``i`` equal those ``q``
before them. Where that count grows long enough, words ``q`` apart agree over several
periods: a run. A cell per pair of equal words would be a square for a frequent word, so a
cell is kept only where it can belong to a run, which needs one earlier occurrence per word
and power of two:

* for lags above ``size / 2`` and up to ``size`` (1, 2, 4, ...), the word at ``i`` opens or
  increments the diagonal of the *nearest* earlier occurrence of the ``size`` words from ``i``
  on. In a run whose smallest period is ``q <= size`` those words occur only whole periods
  apart, so the nearest occurrence is ``q`` back, at every word from the second period on;
* a piece of twice the size that occurs twice has two halves that do, so only words whose
  piece recurs go on to the next size. Ordinary prose has few left after two or three.

So there is at most one active diagonal per size at any word, and one that is not
incremented by the next word ends there; if it is long enough, its run is emitted. The
smallest period needs no check: a shorter one would have been the nearest occurrence.

The texts of a batch are gone through together, with word numbers that no two texts share.

Defined results: a null or empty text has no words and no runs; repeated ids are separate
documents; a null id is a document like others; of runs with the same exponent the one that
starts first, then the one of the smaller period counts as greatest; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventrill.llm.common import in_arrow

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
WORDS_AT_ONCE = 1_000_000  # of several texts; a longer text is gone through alone


def split_words(doc_id: int | None, text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def numbered(texts: list[list[bytes]]) -> np.ndarray:
    """The words of all texts in one row, as numbers that belong to one text each."""
    out, top = [], 0
    for words in texts:
        seen: dict[bytes, int] = {}
        number = seen.setdefault
        out += [number(w, top + len(seen)) for w in words]
        top += len(seen)
    return np.array(out, np.int64)


def _pieces_that_recur(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per piece: the index of the nearest earlier equal one (or -1), if any equals it, and a dense number."""
    order = np.argsort(key, kind="stable")
    as_before = np.r_[False, key[order[1:]] == key[order[:-1]]] if len(key) else np.zeros(0, bool)
    earlier = np.full(len(key), -1)
    earlier[order[as_before]] = order[np.nonzero(as_before)[0] - 1]
    recurs = np.zeros(len(key), bool)
    recurs[order] = as_before | np.r_[as_before[1:], False]
    number = np.empty(len(key), np.int64)
    number[order] = np.cumsum(~as_before)
    return earlier, recurs, number


def find_runs(words: np.ndarray, longest: int, least_length: int, least_exponent: int) -> np.ndarray:
    """``(start, length, period)`` rows of the runs in a row of word numbers, by start, then period.

    ``longest`` is the number of words of the longest text in it: no period is above its
    share of that.
    """
    at, key, size = np.arange(len(words)), words, 1
    found = [np.zeros((0, 3), np.int64)]
    number = np.empty(len(words) + 1, np.int64)
    while len(at) and least_exponent * (size // 2 + 1) <= longest:
        earlier, recurs, dense = _pieces_that_recur(key)
        lag = np.where(earlier >= 0, at - at[earlier], 0)
        cell = np.nonzero((lag > size // 2) & (lag <= size))[0]
        if len(cell):
            i, q = at[cell], lag[cell]
            # a cell is one more than the cell before it on its diagonal, or the first of a new one
            opens = np.r_[True, (i[1:] != i[:-1] + 1) | (q[1:] != q[:-1])]
            first, last = i[opens], i[np.r_[opens[1:], True]]
            period = q[opens]
            start, length = first - period, last + size - first + period
            enough = length >= np.maximum(least_length, least_exponent * period)
            found.append(np.stack([start, length, period], axis=1)[enough])
        number.fill(-1)
        number[at[recurs]] = dense[recurs]
        at = at[recurs]
        second = number[np.minimum(at + size, len(words))]
        at, second = at[second >= 0], second[second >= 0]
        key = number[at] * (len(words) + 1) + second
        size *= 2
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words but those after the first period of a run, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    kept = np.nonzero(np.cumsum(edge)[:-1] == 0)[0]
    return b" ".join([words[i] for i in kept.tolist()])


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RESULT = (
    "doc_id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, "
    "greatest struct<start: bigint, length: bigint, period: bigint>, collapsed string"
)


def _as_structs(runs: np.ndarray) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(runs[:, k])) for k in range(3)], fields=list(_RUN))


def _results(ids: list, texts: list[list[bytes]], least_length: int, least_exponent: int) -> pa.RecordBatch:
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    longest = int(sizes.max(initial=0))
    runs = find_runs(numbered(texts), longest, least_length, least_exponent)
    owner = np.searchsorted(begins + sizes, runs[:, 0], side="right")
    runs[:, 0] -= begins[owner]
    upto = np.searchsorted(owner, np.arange(len(texts) + 1))
    # lengths over periods that differ, differ as floats below some 60 million words
    rank = np.lexsort((runs[:, 2], runs[:, 0], -(runs[:, 1] / runs[:, 2]), owner))
    first = rank[np.minimum(upto[:-1], max(len(rank) - 1, 0))] if len(rank) else np.zeros(len(texts), np.int64)
    none = upto[1:] == upto[:-1]
    greatest = np.where(none[:, None], 0, runs[first]) if len(rank) else np.zeros((len(texts), 3), np.int64)
    greatest_column = pa.StructArray.from_arrays(
        [pa.array(np.ascontiguousarray(greatest[:, k])) for k in range(3)], fields=list(_RUN), mask=pa.array(none)
    )
    collapsed = [
        _collapsed(words, runs[a:b]).decode("utf-8", "surrogatepass")
        for words, a, b in zip(texts, upto[:-1].tolist(), upto[1:].tolist())
    ]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), _as_structs(runs)),
            greatest_column, pa.array(collapsed, pa.string()),
        ],
        ["doc_id", "runs", "greatest", "collapsed"],
    )


Words = Callable[[int | None, str | None], list[bytes]]


def periodic_runs(
    docs: DataFrame, words_of: Words = split_words, least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT
) -> DataFrame:
    """Per document ``doc_id, runs, greatest, collapsed``.

    ``runs`` are the maximal stretches of at least ``least_length`` words and ``least_exponent``
    times their smallest period, by start, then period; ``greatest`` the one of most periods;
    ``collapsed`` the text without what follows the first period of a run. Each document is
    worked on where it is read: nothing is shuffled.
    """
    if least_exponent < 3:
        raise ValueError("runs of fewer than three periods are not found on these diagonals")

    def work(batches):
        for batch in batches:
            ids, texts, n = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(doc_id, text)
                if texts and n + len(words) > WORDS_AT_ONCE:
                    yield _results(ids, texts, least_length, least_exponent)
                    ids, texts, n = [], [], 0
                ids.append(doc_id)
                texts.append(words)
                n += len(words)
            if texts:
                yield _results(ids, texts, least_length, least_exponent)

    return in_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), work, RESULT)
