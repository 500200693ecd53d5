"""Decontamination, chat formatting, packing and token files beside brute force."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from eventrill.llm import catalog, chat, decontam, packing, tokenfile, tokens
from eventrill.llm.common import grouped
from tests.llm.conftest import DOCS, ODD

try:
    import public_tokenizers
    from tokenizers import Tokenizer
except ImportError:
    public_tokenizers = None
with_tokenizers = pytest.mark.skipif(public_tokenizers is None, reason="no tokenizer files here")


def words(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def hits_by_hand(text, items, n):
    windows = {}
    for item, t in items:
        w = words(t)
        for i in range(max(1, len(w) - n + 1)) if w else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    w, hit, found = words(text), set(), set()
    for k, ids in windows.items():
        for i in range(len(w) - len(k) + 1):
            if tuple(w[i : i + len(k)]) == k:
                hit.update(range(i, i + len(k)))
                found |= ids
    return len(w), hit, found


@pytest.fixture
def leaks():
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(6)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([2, 3, 7, 12, 30])))) for i in range(25)]
    items += [(30, None), (31, " .. "), (None, "v1, V2 v3"), (32, items[3][1]), (3, items[3][1]), (3, items[3][1])]
    docs = []
    for i in range(60):
        text = [rng.choice(vocabulary + ["other", "Ünd"]) for _ in range(rng.randrange(0, 60))]
        at = rng.randrange(0, len(text) + 1)
        text[at:at] = words(rng.choice(items)[1])[: rng.randrange(1, 40)]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(text)))
    return docs + [(100, None), (101, ""), (None, "v1 v2 v3")], items


@pytest.mark.parametrize("block_words", [100_000, 40])
def test_contamination(spark, make_docs, leaks, block_words):
    docs, items = leaks
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r["doc_id"]: r for r in decontam.contamination(make_docs(docs), benchmark, block_words=block_words).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        n, hit, found = hits_by_hand(text, items, 10)
        r = got[doc_id]
        covered = {i for s in r["spans"] for i in range(s["start"], s["end"])}
        assert (r["n_words"], covered, r["items"]) == (n, hit, sorted(found))
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))


@pytest.mark.parametrize("block_words,small_hits", [(100_000, 100), (60, 100), (25, 0)])
@pytest.mark.parametrize("max_coverage", [0.0, 0.3, 0.5])
def test_decontaminated_text(spark, make_docs, leaks, block_words, small_hits, max_coverage, monkeypatch):
    monkeypatch.setattr(decontam, "SMALL_HITS", small_hits)
    docs, items = leaks
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    left = decontam.decontaminated(make_docs(docs), benchmark, max_coverage=max_coverage, block_words=block_words)
    assert left.columns == make_docs(docs).columns
    expected = []
    for doc_id, text in docs:
        n, hit, _ = hits_by_hand(text, items, 10)
        if len(hit) <= max_coverage * n:
            expected.append((str(doc_id), [w for i, w in enumerate(words(text)) if i not in hit]))
    got = left.collect()
    assert sorted((str(r["doc_id"]), words(r["text"])) for r in got) == sorted(expected)
    clean = {t for _, t in docs if not hits_by_hand(t, items, 10)[1]}
    assert {r["text"] for r in got} >= clean  # untouched texts stay as they are, null too


def test_coverage_is_added_up_over_blocks(spark, make_docs):
    one, two = (" ".join(f"{c}{i}" for i in range(12)) for c in "ab")
    text = " ".join([one, two, *(f"own{i}" for i in range(14))])  # 24 of 38 words are hit, 12 by each item
    benchmark = spark.createDataFrame([(1, one), (2, two)], "item_id bigint, text string")
    for block_words in (100_000, 5):
        assert decontam.decontaminated(make_docs([(1, text)]), benchmark, block_words=block_words).count() == 0
        cut = decontam.decontaminated(make_docs([(1, text)]), benchmark, max_coverage=0.7, block_words=block_words).first()
        assert cut["text"].split() == [f"own{i}" for i in range(14)]


def test_contamination_of_odd_and_empty_tables(spark, odd_docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert {len(r["spans"]) for r in decontam.contamination(odd_docs, none).collect()} == {0}
    assert decontam.contamination(odd_docs, none).count() == len(ODD)
    assert decontam.contamination(spark.createDataFrame([], DOCS), none).count() == 0


TEXTS = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\n&l", "&a&l&b&n", "", None, "line\nline\n\n", "é<"]


def test_chat_reads_back_what_was_said(spark):
    rng = random.Random(3)
    turns, clash = [], (7, "x")
    for c in [*range(20), None]:
        for t in range(rng.randrange(1, 12)):
            role = rng.choice(["user", "assistant", "system", None, "odd\nrole<&", "assistant"])
            turns.append((c, rng.choice([t, 3, None]), role, rng.choice(TEXTS), *clash))
    turns += [(50, t, ("user", "assistant")[t % 2], f"turn {t}", *clash) for t in range(133)]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string, at int, branch string")
    out = chat.read_back(chat.formatted(chat.reply_chain(df))).collect()
    by = {}
    for c, t, role, text, *_ in turns:
        by.setdefault(c, []).append((t is None, t or 0, role is not None, role or "", text is not None, text or ""))
    assert {r["conv_id"] for r in out} == set(by) and len(out) == len(by)
    for r in out:
        want = [(x[3], x[5]) for x in sorted(by[r["conv_id"]])]
        assert [(t["role"], t["text"]) for t in r["turns"]] == want
        assert r["learned"] == [t for role, t in want if role == "assistant"]
        assert r["n_turns"] == len(want)
        marks = r["formatted"].replace(chat.START, "").replace(chat.END, "")
        assert not re.search(r"[<\[]", marks)
    assert chat.formatted(chat.reply_chain(df.limit(0))).count() == 0


def test_branches_of_a_reply_tree(spark):
    rng = random.Random(8)
    rows = []
    for c in range(6):
        for m in range(1, 30):
            parent = None if m == 1 else rng.randrange(max(1, m - 4), m)
            rows.append((c, m, parent, "user", f"{c}-{m}", float(rng.randrange(4))))
    rows += [(9, 1, 2, "user", "cycle", 1.0), (9, 2, 1, "user", "cycle", 1.0), (10, 5, 77, "user", "lost parent", None)]
    df = spark.createDataFrame(rows, "conv_id bigint, msg_id bigint, parent_id bigint, role string, text string, score double")
    got = {}
    for r in chat.paths(df, branches=3).collect():
        got.setdefault((r["conv_id"], r["branch"]), []).append((r["at"], r["msg_id"]))
    want = {}
    for c in [*range(6), 10]:
        mine = {m: (p, s or 0.0) for cc, m, p, _, _, s in rows if cc == c}
        leaves = set(mine) - {p for p, _ in mine.values()}

        def path(m):
            out = [m]
            while mine[out[0]][0] in mine:
                out.insert(0, mine[out[0]][0])
            return out

        ranked = sorted(leaves, key=lambda m: (-sum(mine[x][1] for x in path(m)), -len(path(m)), m))[:3]
        for b, leaf in enumerate(ranked):
            want[(c, b + 1)] = list(enumerate(path(leaf), 1))
    assert {k: sorted(v) for k, v in got.items()} == want


def check_packing(rows, length=2048):
    ends, sequences = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
        ends[len(ends)] = at
    return sum(ends.values()), len(sequences)


@with_tokenizers
@pytest.mark.parametrize("bucket_rows", [20_000, 3])
def test_packing(odd_docs, bucket_rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.shared_table(packing.cut_documents(odd_docs, path), "test")
    rows = packing.pack(pieces, bucket_rows=bucket_rows).collect()
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    want = []
    for doc_id, text in ODD:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for at in range(0, len(ids), 2048):
            part = ids[at : at + 2048]
            want.append((doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids)))
    assert sorted(tuple(r)[:5] for r in rows) == sorted(want)
    check_packing(rows)


def test_packing_wastes_little(spark):
    rng = random.Random(1)
    rows = [(i, 0, min(2048, 1 + int(rng.expovariate(1 / 600))), 0, 0) for i in range(20_000)]
    pieces = packing.shared_table(spark.createDataFrame(rows, packing.PIECES), "test")
    used, n = check_packing(packing.pack(pieces).collect())
    assert used == sum(r[2] for r in rows) and used / (2048 * n) > 0.99
    assert packing.pack(packing.shared_table(spark.createDataFrame([], packing.PIECES), "test")).count() == 0


def test_patterns_cover_the_histogram():
    rng = np.random.default_rng(0)
    for _ in range(10):
        counts = rng.integers(0, 50, 64) * (rng.random(64) < 0.4)
        plan = packing.solve(counts, 64)
        assert (sum((p * n for p, n in plan), np.zeros(64, int)) == counts).all()
        assert all(p @ np.arange(1, 65) <= 64 and n > 0 for p, n in plan)


def test_knapsack_is_optimal():
    rng = np.random.default_rng(1)
    for _ in range(20):
        prices = rng.random(9) * (rng.random(9) < 0.7)
        best = [0.0] * 10
        for room in range(1, 10):
            best[room] = max([best[room - 1]] + [best[room - k - 1] + prices[k] for k in range(room)])
        worth, pattern = packing.best_pattern(prices, 9)
        assert worth == pytest.approx(best[9]) == pytest.approx(prices @ pattern) and pattern @ np.arange(1, 10) <= 9


ODD_TEXTS = [
    "", "a", " a", "a ", "a  b", "a\n\nb", "a\nb", "\n", "a\tb c", "x \ny", "a \x1c b", "it's we'll  't", "é à́",
    "<|endoftext|> <|startoftext|>", "Ünï çödé ΑΣ. ΑΣ b", "a\xa0b c", "日本 語 a", "\U0001f600 x y", "a ́b", "1 23 456",
]


@with_tokenizers
@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_pieces_give_the_ids_of_whole_texts(name, spaced):
    path = public_tokenizers.path(name)
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    rng = random.Random(7)
    made = ["".join(rng.choice([" ", " ", "\n", "ab", "C", "é", ".", "'s", "7", "\t"]) for _ in range(30)) for _ in range(300)]
    texts = ODD_TEXTS + made
    want = [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]
    assert tokens.Encoder(path, spaced).encode(texts) == want


@with_tokenizers
@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_columns_give_the_ids_of_whole_texts(name, spaced, monkeypatch):
    path = public_tokenizers.path(name)
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    rng = random.Random(11)
    signs = [" ", " ", " ", "\n", "ab", "C", "é", ".", "'s", "7", "\t", "日", "’", "\u3000", "\u2009", "\xa0", "\0", "\x85", "ß"]
    made = ["".join(rng.choice(signs[: rng.choice([9, 11, 13, 19])]) for _ in range(rng.randrange(40))) for _ in range(1_000)]
    texts = ["", None, *ODD_TEXTS, *made, "", "a b  c", "a ", " b", "x" * 300, None]
    want = [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]
    monkeypatch.setattr(tokens, "CACHED_PIECES", 50)
    encode = tokens.Encoder(path, spaced).encode_column
    assert encode(pa.array(texts)) == want
    assert [x for at in range(0, len(texts), 9) for x in encode(pa.array(texts).slice(at, 9))] == want
    assert encode(pa.array([], pa.string())) == [] and encode(pa.array([None, ""], pa.string())) == [b"", b""]
    assert encode(pa.array(["only"])) == encode(pa.array(["only"], pa.large_string()))


@with_tokenizers
def test_a_column_is_encoded_by_its_different_pieces(monkeypatch):
    encode, asked = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"), True), []
    monkeypatch.setattr(encode, "_ids_of", lambda pieces, alone, f=encode._ids_of: asked.append(pieces) or f(pieces, alone))
    texts = [" ".join(["first", *["same"] * 100, f"own{i}"]) for i in range(20)]
    assert encode.encode_column(pa.array(texts)) == encode.encode(texts)
    assert [sorted(p) for p in asked] == [sorted([b"first", b" same", *(b" own%d" % i for i in range(20))])]


def test_batches_are_put_together():
    sizes, rows = [3, 1, 0, 40, 2, 2, 9, 1], []
    batches = [pa.record_batch({"n": pa.array([k] * n, pa.int64())}) for k, n in enumerate(sizes)]
    for batch in grouped(iter(batches), most=8 * 6):
        assert batch.num_rows <= 6 or batch.num_rows in (40, 9)
        rows += batch.column(0).to_pylist()
    assert rows == [k for k, n in enumerate(sizes) for _ in range(n)] and list(grouped(iter([]))) == []


@with_tokenizers
def test_token_files(odd_docs, spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = tokenfile.round_trip(odd_docs, path).collect()
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    at, want = 0, []
    for doc_id, text in sorted(ODD, key=lambda r: r[0]):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in rows) == sorted(want)
    assert tokenfile.round_trip(spark.createDataFrame([], DOCS), path).count() == 0


def test_grammar_round_trip_and_random_access():
    rng = random.Random(2)
    for trial in range(20):
        ids = np.array([rng.choice([1, 1, 2, 3, 50_000]) for _ in range(rng.randrange(1, 4_000))], np.uint32)
        cuts = sorted(rng.sample(range(len(ids) + 1), min(3, len(ids))))
        counts = np.diff([0, *cuts, len(ids)])
        data = tokenfile.pack_block([None, *range(len(counts) - 1)], counts, ids, pairs=rng.choice([3, 100]), rounds=rng.choice([1, 4, None]))
        block = tokenfile.Block(data)
        assert (block.ids() == ids).all() and block.doc_ids[0] is None
        for k, (a, b) in enumerate(zip(np.cumsum(counts) - counts, np.cumsum(counts))):
            assert (block.document(k) == ids[a:b]).all()
    repeated = np.tile(np.arange(50, dtype=np.uint32), 2_000)
    assert len(tokenfile.pack_block([1], np.array([100_000]), repeated)) < 100_000


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="given tables are not here")
def test_decontamination_query(spark):
    sf = "/root/testdata/sf0.001"
    items = [tuple(r) for r in catalog.table(spark, sf, "benchmark").select("item_id", "text").collect()]
    texts = {r["doc_id"]: r["text"] for r in catalog.table(spark, sf, "documents").collect()}
    for r in catalog.op5_decontamination(spark, sf).collect():
        n, hit, found = hits_by_hand(texts[r["doc_id"]], items, 10)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert tuple(r)[1:] == (n, len(hit), len(found), digest, bool(hit))
