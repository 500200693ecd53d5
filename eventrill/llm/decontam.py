"""Benchmark decontamination by a generalised suffix automaton of the test items.

The automaton holds the normalised words of all items of one block. A document's words are
streamed through it; after each word it knows the longest run of words, ending there, that
occurs in some item. A window is ``window`` consecutive words of an item (a shorter item is
one window); words inside any occurrence of a window are hit, and hit spans can be removed.

Items are taken in blocks of bounded size, one pass over the documents for each, so a large
test set never has to fit into one task. The blocks' spans are gathered before anything is
decided, so the result does not depend on them.

Defined results: null and empty texts have no words and are clean; an item without words is
ignored; equal items, and rows that repeat an item's id, count once per id; an item with a
null id is found like others and listed as an empty string; an empty benchmark leaves every
document clean; repeated documents give one row each; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventrill.llm.common import in_arrow, is_small, shared_table

WINDOW = 10
BLOCK_WORDS = 100_000  # item words in one automaton
SMALL_HITS = 50_000  # documents, with their spans

# bytes that are words' bytes once A-Z is lower-cased: digits, a-z, and everything not ASCII
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


class Automaton:
    """Generalised suffix automaton over word numbers, with the items of each window."""

    def __init__(self, items: Iterable[tuple[str, Sequence[bytes]]], window: int) -> None:
        self.window, self.number = window, {}
        self._next, self._link, self._length = [{}], [-1], [0]
        self._items: list[set[str] | None] = [None]  # of the window that ends a state's strings
        self._short: list[tuple[int, set[str]] | None] = [None]  # whole items shorter than a window
        kept = [(item, [self.number.setdefault(w, len(self.number)) for w in words]) for item, words in items if words]
        for _, word_ids in kept:
            last = 0
            for c in word_ids:
                last = self._extend(last, c)
        for item, word_ids in kept:
            self._mark(item, word_ids)
        self._any_short = any(self._short)
        self.shortest = min((min(window, len(ids)) for _, ids in kept), default=window)

    def _state(self, follow: dict, link: int, length: int) -> int:
        for column, value in (
            (self._next, follow), (self._link, link), (self._length, length), (self._items, None), (self._short, None)
        ):
            column.append(value)
        return len(self._next) - 1

    def _clone(self, of: int, p: int, c: int) -> int:
        new = self._state(dict(self._next[of]), self._link[of], self._length[p] + 1)
        self._link[of] = new
        while p != -1 and self._next[p].get(c) == of:
            self._next[p][c] = new
            p = self._link[p]
        return new

    def _extend(self, last: int, c: int) -> int:
        if (q := self._next[last].get(c)) is not None:
            return q if self._length[q] == self._length[last] + 1 else self._clone(q, last, c)
        new, p = self._state({}, 0, self._length[last] + 1), last
        while p != -1 and c not in self._next[p]:
            self._next[p][c] = new
            p = self._link[p]
        if p != -1:
            q = self._next[p][c]
            self._link[new] = q if self._length[q] == self._length[p] + 1 else self._clone(q, p, c)
        return new

    def _holder(self, state: int, n: int) -> int:
        """The state that stands for the last ``n`` words of a state's strings."""
        while self._length[self._link[state]] >= n:
            state = self._link[state]
        return state

    def _mark(self, item: str, word_ids: Sequence[int]) -> None:
        state = 0
        for at, c in enumerate(word_ids):
            state = self._next[state][c]
            if at + 1 >= self.window:
                state = self._holder(state, self.window)
                self._items[state] = (self._items[state] or set()) | {item}
        if len(word_ids) < self.window:
            state = self._holder(state, len(word_ids))
            whole = self._short[state]
            self._short[state] = (len(word_ids), (whole[1] if whole else set()) | {item})

    def hits(self, words: Sequence[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans of hit words, and the ids of the items whose windows occur."""
        get = self.number.get
        numbers = [get(w, -1) for w in words]
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        at, n = 0, len(numbers)
        while at < n:
            if numbers[at] < 0:
                at += 1
                continue
            end = at
            while end < n and numbers[end] >= 0:
                end += 1
            if end - at >= self.shortest:
                self._walk(numbers, at, end, spans, found)
            at = end
        return _merged(spans), found

    def _walk(self, numbers, at: int, end: int, spans: list, found: set) -> None:
        state = length = 0
        for i in range(at, end):
            c = numbers[i]
            while state and c not in self._next[state]:
                state = self._link[state]
                length = self._length[state]
            if c in self._next[state]:
                state, length = self._next[state][c], length + 1
            if length >= self.window:
                spans.append((i + 1 - self.window, i + 1))
                found |= self._items[self._holder(state, self.window)]
            s = state if self._any_short else 0
            while s > 0:
                whole = self._short[s]
                if whole and whole[0] <= length:
                    spans.append((i + 1 - whole[0], i + 1))
                    found |= whole[1]
                s = self._link[s]


def _merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(s) for s in out]


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
SPANS = (
    "doc_id bigint, text_hash bigint, n_words bigint, spans array<struct<start: bigint, end: bigint>>, "
    "items array<string>"
)


def _scan(docs: DataFrame, automaton: Automaton) -> DataFrame:
    def work(batches):
        for batch in batches:
            sizes, spans, items = [], [], []
            for text in batch.column(2).to_pylist():
                words = words_of(text)
                where, what = automaton.hits(words)
                sizes.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in where])
                items.append(sorted(what))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(_SPAN)),
                 pa.array(items, pa.list_(pa.string()))],
                ["doc_id", "text_hash", "n_words", "spans", "items"],
            )

    ids = F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash")
    return in_arrow(docs.select(*ids, "text"), work, SPANS)


def _automata(benchmark: DataFrame, window: int, block_words: int) -> tuple[int, Iterator[Automaton]]:
    """The number of blocks of items, and their automata; one block at a time is on the driver."""
    item = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id")
    items = benchmark.select(item, "text").where(F.col("text").isNotNull()).distinct()
    chars = items.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    blocks = int(chars // (2 * block_words)) + 1  # a word and what parts it from the next: two characters or more

    def made():
        for i in range(blocks):
            rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i).collect()
            yield Automaton([(r["item_id"], words_of(r["text"])) for r in sorted(rows)], window)

    return blocks, made()


def _gathered(docs: DataFrame, automata: Iterator[Automaton]) -> DataFrame:
    """``doc_id, text_hash, n_words, spans, items`` of every text: what all blocks find, spans merged."""
    # a block's pass is over before the next automaton is made
    scans = [shared_table(_scan(docs, automaton), "decontam") for automaton in automata]
    found = reduce(DataFrame.unionByName, scans).dropDuplicates()
    joined = found.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("_spans"),  # a row per block
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    kind = "array<struct<start: bigint, end: bigint>>"
    empty = F.array().cast(kind)

    def step(acc, s):
        last = F.get(acc, F.size(acc) - 1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        apart = (F.size(acc) == 0) | (s["start"] > last["end"])
        return F.when(apart, F.concat(acc, F.array(s))).otherwise(
            F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(longer))
        )

    merged = F.aggregate(F.array_sort("_spans"), empty, step)
    return joined.select("doc_id", "text_hash", "n_words", merged.alias("spans"), "items")


def _same_text(left: str, right: str) -> Column:
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (F.col(f"{left}.text_hash") == F.col(f"{right}.text_hash"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """Per document ``doc_id, n_words, spans, items``: merged spans of hit words, ids of the items found."""
    blocks, automata = _automata(benchmark, window, block_words)
    if blocks == 1:
        return _scan(docs, next(automata)).drop("text_hash")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"))
    joined = rows.alias("l").join(_gathered(docs, automata).alias("r"), _same_text("l", "r"))
    return joined.select("l.doc_id", "n_words", "spans", "items")


def hit_words() -> Column:
    """Number of words in the ``spans`` of ``contamination``."""
    return F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])


_WORD = re.compile(rb"[^ ]+")


def _cut(text: str, spans: Sequence[tuple[int, int]]) -> str:
    raw = text.encode("utf-8", "surrogatepass")
    words = [m.span() for m in _WORD.finditer(raw.translate(_TO_WORDS))]
    kept, at = [], 0
    for start, end in spans:
        kept.append(raw[at : words[start][0]])
        at = words[end - 1][1]
    return b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass")


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    max_coverage: float = 0.5,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` without hit spans, and without documents of which more than ``max_coverage`` is hit.

    With ``max_coverage=0`` every document that holds a window of an item goes. All columns
    stay as they are, but for the cut ``text``. What is hit is judged on the whole text, by all
    items together, however they are dealt into blocks. With one block nothing is shuffled; with
    more, the spans of the documents that are hit are joined to their texts.
    """
    blocks, automata = _automata(benchmark, window, block_words)
    at = docs.columns.index("text")
    if blocks == 1:
        automaton = next(automata)
        return in_arrow(docs, _remover(at, max_coverage, lambda words, _: automaton.hits(words)[0]), docs.schema)
    hits = shared_table(_gathered(docs, automata).where(F.size("spans") > 0).select("doc_id", "text_hash", "spans"), "decontam")
    side = F.broadcast(hits) if is_small(hits, SMALL_HITS) else hits
    side = side.select(F.col("doc_id").alias("_hit_id"), F.col("text_hash").alias("_hit_text"), F.col("spans").alias("_hit_spans"))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_hit_id")) & (F.xxhash64("text") == F.col("_hit_text"))
    joined = docs.join(side, same, "left").select(*docs.columns, "_hit_spans")
    given = lambda _, spans: [(s["start"], s["end"]) for s in spans or ()]
    return in_arrow(joined, _remover(at, max_coverage, given), docs.schema)


def _remover(at: int, max_coverage: float, spans_of: Callable[[list[bytes], list | None], list[tuple[int, int]]]):
    """Cuts or drops texts; ``spans_of`` takes a text's words and what the column after the last one holds."""

    def work(batches):
        for batch in batches:
            keep, texts = [], []
            width = len(batch.schema.names)
            known = batch.column(width - 1).to_pylist() if batch.schema.names[-1] == "_hit_spans" else [None] * batch.num_rows
            for text, found in zip(batch.column(at).to_pylist(), known):
                words = words_of(text)
                spans = spans_of(words, found)
                hit = sum(b - a for a, b in spans)
                keep.append(hit == 0 or hit <= max_coverage * len(words))
                texts.append(_cut(text, spans) if spans and keep[-1] else text)
            columns = batch.columns[: width - (batch.schema.names[-1] == "_hit_spans")]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            fields = [batch.schema.field(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields)).filter(pa.array(keep, pa.bool_()))

    return work
