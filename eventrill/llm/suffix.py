"""Removal of long repeated byte strings with a run-length (r-) index.

Candidate segments (see ``passages``) of a block of anchors are laid end to end and sorted
by the first ``n`` bytes at each position. The Burrows-Wheeler transform of that order is
kept run by run: where each symbol's runs start, how many of the symbol lie before, and, at
the ends of the groups of equal ``n``-byte strings, the smallest document that has the
string. Segments are streamed from right to left: one backward step per byte, from the
interval of the last ``n - 1`` matched bytes, gives the interval of the next window, and its
sample tells whether an earlier document has it. So the matching statistic against earlier
documents is followed as far as asked for, ``n`` bytes.

Repeats, copies above all, make long runs: equal segments are kept once, with the smallest
document, before the transform is built, and an anchor all of whose segments are equal needs
no index.

Defined results: null is empty; texts shorter than ``n`` stay whole; copies count as
occurrences, and rows that repeat an id do not count against each other; a null id comes
after all others, and null ids do not count against each other; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventrill.llm.common import in_arrow
from eventrill.llm.passages import merged, mix, repeated_runs, with_spans

LENGTH = 50
GRAM = 20
BLOCK_UNITS = 4_000_000  # a quarter of them, or so, comes into the index
SEPARATOR = 0xFF  # occurs in no UTF-8 text

_CODES = mix(np.random.default_rng(3).integers(1, 2**63, 256, dtype=np.uint64))


def _byte_codes():
    return lambda texts: [_CODES[np.frombuffer((t or "").encode("utf-8", "surrogatepass"), np.uint8)] for t in texts]


_ORDER = np.argsort(_CODES)
_SORTED = _CODES[_ORDER]


def _payloads(first, last, row, n) -> list[bytes]:
    raw = _ORDER[np.searchsorted(_SORTED, row)].astype(np.uint8).tobytes()
    return [raw[a : b + n - 1] for a, b in zip(first.tolist(), last.tolist())]


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """Order of the keys, dense ranks, and whether all are different."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.r_[False, ordered[1:] != ordered[:-1]]
    ranks = np.empty(len(keys), np.uint64)
    ranks[order] = np.cumsum(new).astype(np.uint64)
    return order, ranks, bool(new[1:].all())


class RunIndex:
    """Run-length Burrows-Wheeler transform of segments, with the smallest document of every group.

    ``text`` has a separator after each segment; ``ids`` gives each position's document.
    """

    def __init__(self, text: np.ndarray, ids: np.ndarray, n: int) -> None:
        self.n, size = n, len(text)
        padded = np.concatenate([text, np.full(2 * n + 8, SEPARATOR, np.uint8)])
        key = padded.astype(np.uint64)
        width = 1
        while 2 * width <= min(8, n):  # the first eight bytes as one number, most significant first
            key = (key[:-width] << np.uint64(8 * width)) | key[width:]
            width *= 2
        order, rank, done = _ranks(key[:size])

        def beyond(rank, shift):
            out = np.full(size, size, np.uint64)  # past the end comes last
            if shift < size:
                out[: size - shift] = rank[shift:]
            return out

        while 2 * width <= n:
            order, rank, done = _ranks((rank << np.uint64(32)) | beyond(rank, width))
            width *= 2
        ahead = beyond(rank, n - width)
        order, self._rank, _ = _ranks((rank << np.uint64(32)) | ahead)
        # borders of groups that agree in n bytes, and in n - 1
        self._group_of = self._rank.astype(np.int64)
        border = np.r_[True, self._rank[order][1:] != self._rank[order][:-1]]
        nearly = beyond(rank, n - 1 - width) if n - 1 >= width else rank
        shorter = np.r_[True, (rank[order][1:] != rank[order][:-1]) | (nearly[order][1:] != nearly[order][:-1])]
        starts = np.nonzero(border)[0]
        self._starts = starts
        self.owners = np.minimum.reduceat(ids[order], starts)
        self._narrow = np.maximum.accumulate(np.where(shorter, np.arange(size), 0))[starts]
        # runs of the transform
        before = text[order - 1]
        run = np.nonzero(np.r_[True, before[1:] != before[:-1]])[0]
        symbol, length = before[run].astype(np.int64), np.diff(np.r_[run, size])
        by = np.lexsort((run, symbol))
        self._size = size
        self._keys = symbol[by] * (size + 1) + run[by]
        self._run_start, self._run_length = run[by], length[by]
        self._before = np.cumsum(length[by]) - length[by]  # over all smaller symbols, and runs of the same
        self._first_run = np.searchsorted(symbol[by], np.arange(257))
        self._smaller = np.r_[0, np.cumsum(np.bincount(text, minlength=256))]
        self.runs = len(run)

    def step(self, groups: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Groups of the windows one byte further left, whose first byte is ``symbols``."""
        at, symbols = self._narrow[groups], symbols.astype(np.int64)
        run = np.searchsorted(self._keys, symbols * (self._size + 1) + at, side="left") - 1
        first = self._first_run[symbols]
        inside = run >= first
        run = np.maximum(run, 0)
        base = np.take(self._before, first, mode="clip")
        rank = np.where(inside, self._before[run] - base + np.minimum(at - self._run_start[run], self._run_length[run]), 0)
        position = self._smaller[symbols] + rank
        return np.searchsorted(self._starts, position, side="right") - 1

    def group_at(self, positions: np.ndarray) -> np.ndarray:
        return self._group_of[positions]


def _first_ids(anchors, ids, windows, payloads, n=LENGTH) -> np.ndarray:
    """Smallest document of every window of a block, whose rows come ordered by anchor.

    Where all segments of an anchor are the same bytes, as within a passage that was copied, the
    smallest document is that of all their windows. The others are streamed through an index.
    """
    number: dict[bytes, int] = {}
    which = np.array([number.setdefault(p, len(number)) for p in payloads], np.int64)
    begin = np.nonzero(np.r_[True, anchors[1:] != anchors[:-1]])[0]
    sizes = np.diff(np.r_[begin, len(anchors)])
    alike = np.repeat(np.maximum.reduceat(which, begin) == np.minimum.reduceat(which, begin), sizes)
    first = np.repeat(np.repeat(np.minimum.reduceat(ids, begin), sizes), windows)
    if not alike.all():
        rest = ~alike
        used, which = np.unique(which[rest], return_inverse=True)
        texts = list(number)
        first[np.repeat(rest, windows)] = _streamed([texts[k] for k in used.tolist()], which, ids[rest], windows[rest], n)
    return first


def _streamed(texts: list[bytes], which: np.ndarray, ids: np.ndarray, windows: np.ndarray, n: int) -> np.ndarray:
    """The same by the index of the different ``texts``; ``which`` is the text of each row."""
    least = np.full(len(texts), np.iinfo(np.int64).max)
    np.minimum.at(least, which, ids)
    sizes = np.array([len(p) for p in texts], np.int64)
    text = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    index = RunIndex(text, np.repeat(least, sizes + 1), n)
    # all segments walk left together, each from its last window
    counts = sizes - n + 1
    offsets = np.cumsum(counts) - counts
    first = np.empty(counts.sum(), np.int64)
    order = np.argsort(-counts, kind="stable")
    active, groups = order, index.group_at(begins[order] + counts[order] - 1)
    step = 1
    while len(active):
        first[offsets[active] + counts[active] - step] = index.owners[groups]
        step += 1
        left = np.searchsorted(-counts[active], -step, side="right")
        active, groups = active[:left], groups[:left]
        if left:
            groups = index.step(groups, text[begins[active] + counts[active] - step])
    at = np.repeat(offsets[which] - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    return first[at]


def repeated_bytes(docs: DataFrame, n: int = LENGTH, gram: int = GRAM, **limits) -> DataFrame:
    """``doc_id, text, spans``: byte runs that an earlier document has, in strings of ``n`` bytes."""
    decide = lambda a, i, w, p: _first_ids(a, i, w, p, n)
    limits = {"block_units": BLOCK_UNITS, **limits}
    runs = repeated_runs(docs, _byte_codes, _payloads, decide, n, gram, "suffix", **limits)
    return with_spans(docs, runs)


def kept_bytes(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for start, end in spans:
        kept.append(raw[at:start])
        at = end
    return b"".join([*kept, raw[at:]])


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def deduplicated(docs: DataFrame, n: int = LENGTH, **limits) -> DataFrame:
    """Per document ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``; ``kept`` are the remaining bytes.

    They are bytes, not text: a run may begin or end inside a character.
    """

    def work(batches):
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw, spans = (text or "").encode("utf-8", "surrogatepass"), merged(spans)
                kept = kept_bytes(raw, spans)
                rows.append((len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            )

    return in_arrow(repeated_bytes(docs, n, **limits).select("doc_id", "text", F.col("spans")), work, RESULT)
