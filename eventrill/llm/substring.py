"""Removal of repeated word passages by level-wise doubling, in two levels.

Windows of words are looked at at half the length asked for and then at that length. Those
of the first level that occur in one document alone can be in no longer repeat; the others
are extended to twice the length and compared again. At the first level only the windows
that lead a longer one (see ``passages``) are counted, so that the counts are a fraction of
the words; every window of the last level has such a leader.

Windows are compared by two independent 64-bit hashes of their words' hashes.

Defined results: null and empty texts have no words and stay empty; texts shorter than ``n``
words stay whole; copies count as occurrences, and rows that repeat an id do not count
against each other; a null id comes after all others; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from eventrill.llm.common import in_arrow
from eventrill.llm.passages import gram_hashes, merged, mix, repeated_runs, with_spans

WORDS = 50

_BASE = np.uint64(0xA0761D6478BD642F)  # any odd number does


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _word_codes():
    digest = xxhash.xxh3_64_intdigest
    return lambda texts: [np.array([digest(w) for w in words_of(t)], np.uint64) for t in texts]


def _payloads(first, last, row, n) -> list[bytes]:
    windows = mix(gram_hashes(row, n, _BASE))
    return [windows[a:b].tobytes() for a, b in zip(first.tolist(), last.tolist())]


def _first_ids(anchors, ids, windows, payloads) -> np.ndarray:
    """Smallest document of every window: equal windows have equal anchors and hashes."""
    k1, k2 = np.repeat(anchors, windows), np.frombuffer(b"".join(payloads), np.int64)
    order = np.lexsort((k2, k1))
    a, b = k1[order], k2[order]
    starts = np.nonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])[0]
    least = np.minimum.reduceat(np.repeat(ids, windows)[order], starts)
    out = np.empty(len(order), np.int64)
    out[order] = np.repeat(least, np.diff(np.r_[starts, len(order)]))
    return out


def repeated_words(docs: DataFrame, n: int = WORDS, **limits) -> DataFrame:
    """``doc_id, text, spans``: word runs that an earlier document has, in windows of ``n`` words."""
    runs = repeated_runs(
        docs, _word_codes, _payloads, _first_ids, n, -(-n // 2), "substring", **limits
    )
    return with_spans(docs, runs)


RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string"


def deduplicated(docs: DataFrame, n: int = WORDS, **limits) -> DataFrame:
    """Per document ``doc_id, n_words, n_removed, kept_sha256, kept``; ``kept`` are the words left, joined by a space."""

    def work(batches):
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words, kept, at = words_of(text), [], 0
                for start, end in merged(spans):
                    kept += words[at:start]
                    at = end
                kept += words[at:]
                left = b" ".join(kept)
                digest = hashlib.sha256(left).hexdigest()
                rows.append((len(words), len(words) - len(kept), digest, left.decode("utf-8", "surrogatepass")))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 4, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
            )

    return in_arrow(repeated_words(docs, n, **limits), work, RESULT)
