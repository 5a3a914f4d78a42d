"""Alignment of tokenizers, periodic runs and packing against brute force."""

import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cartwright.llm import alignment, bin_completion, packing, periodicity, queries, subwords

FOLDER = "/root/testdata/sf0.001"
TOKENIZERS = "/opt/tokenizers"
A, B = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
WORDS = f"{TOKENIZERS}/word_bpe_49k.json"
needs_files = pytest.mark.skipif(not os.path.exists(A), reason="no tokenizer files here")
needs_data = pytest.mark.skipif(not os.path.exists(FOLDER), reason="no tables here")

ODD = [
    None, "", " ", "a  b", "\n\nfoo bar\n", "tab\tx \t y", "it's we'll  don't", "\x1c a \x85 b\xa0c!\x1cd ! \x1c",
    "日本語 テキスト", "😀😀 x", "é é ñ", "<|endoftext|> a<s>b </s>", "▁ x", "x▁y", "﻿bom", "\x00 nul",
    "==============-------====", "İstanbul ΣΣ ς", "̈ a ̈b", "H̱ Å", "0123456789 12 3", "word " * 700,
]


def odd_texts(n):
    rng = random.Random(7)
    letters = list("ab c\n\t.,!?'12éß\xa0日😀\x1c\x85　́")
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(n)]


def table(spark, texts, more=""):
    rows = [(i if i % 7 else None, t, i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, f"doc_id long, text string, row long{more}").repartition(3)


# Alignment


def groups_by_hand(texts):
    """Per text the groups ([A ids], [B ids]), straight from the definition."""
    import json

    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    letters = subwords.byte_alphabet()
    spelled_a = {i: bytes(letters[c] for c in t if c in letters) for t, i in json.load(open(A))["model"]["vocab"].items()}
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    out = []
    for text in texts:
        whole = f" {text}".encode() if text else b""
        ids_a = a.encode(whole.decode(), add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        sides = []
        for ids, spell in (
            (ids_a, spelled_a.__getitem__),
            (ids_b, lambda i: alignment.piece_bytes(b.id_to_piece(i), b.is_byte(i))),
        ):
            at, ends = 0, []
            for i in ids:
                at += len(spell(i))
                ends.append(at)
            sides.append((ids, ends, b"".join(map(spell, ids))))
        if not text or sides[0][2] != whole or sides[1][2] != whole:
            out.append([])
            continue
        cuts = sorted(set(sides[0][1]) & set(sides[1][1]))
        groups, before = [], 0
        for cut in cuts:
            groups.append(tuple([i for i, e in zip(ids, ends) if before < e <= cut] for ids, ends, _ in sides))
            before = cut
        out.append(groups)
    return out


def counts_by_hand(groups):
    links = [Counter((x, y) for xs, ys in g for x in xs for y in ys) for g in groups]
    held = Counter(p for c in links for p in c)
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    rows = []
    for g, c in zip(groups, links):
        text = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in g)
        rows.append((
            sum(len(xs) for xs, _ in g), sum(len(ys) for _, ys in g), len(g), sum(c.values()),
            sum(n for p, n in c.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in c.items()),
            hashlib.sha256(text.encode()).hexdigest() if g else "",
        ))
    return rows


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@needs_files
@pytest.mark.parametrize("hot", [alignment.HOT, 40, 0])
def test_links_equal_the_definition(spark, hot):
    texts = odd_texts(150) + ["the same text again"] * 5
    want = counts_by_hand(groups_by_hand(texts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.linked_pairs(docs, A, B, hot).collect()}
    assert [got[i] for i in range(len(texts))] == want


@needs_files
def test_alignment_gives_tokens_and_groups(spark):
    texts = odd_texts(60)
    out = alignment.with_alignment(table(spark, texts).withColumnRenamed("doc_id", "a_ids"), A, B)
    rows = {r["row"]: r for r in out.collect()}
    assert out.columns == ["a_ids", "text", "row", "alignment"] and len(rows) == len(texts)
    for i, groups in enumerate(groups_by_hand(texts)):
        got = rows[i]["alignment"]
        assert got["a_ids"] == [x for xs, _ in groups for x in xs] and got["b_ids"] == [y for _, ys in groups for y in ys]
        assert got["a_sizes"] == [len(xs) for xs, _ in groups] and got["b_sizes"] == [len(ys) for _, ys in groups]


@needs_files
def test_links_without_rows_and_with_repeated_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, n_a string")
    assert alignment.linked_pairs(empty, A, B).count() == 0
    docs = spark.createDataFrame([(None, "one text")] * 3 + [(1, "one text"), (1, "another")], "doc_id long, text string")
    rows = alignment.linked_pairs(docs, A, B).collect()
    assert Counter(r["doc_id"] for r in rows) == {None: 3, 1: 2}
    assert len({r["count_sum"] for r in rows if r["n_a"] == rows[0]["n_a"]}) <= 2


def test_lockstep_with_lanes_finds_all_joint_ends():
    rng = np.random.default_rng(3)
    for _ in range(20):
        sizes = rng.integers(1, 4000, 5)
        parts = []
        for n in sizes:
            a, b = (np.unique(np.append(rng.choice(n, max(1, n // 2)), n - 1)) + 1 for _ in range(2))
            parts.append((a, b, n))
        shift = np.cumsum([0, *(n for *_, n in parts)])
        ends = [np.concatenate([p[k] + s for p, s in zip(parts, shift)]) for k in (0, 1)]
        first = [np.cumsum([0, *(len(p[k]) for p in parts)])[:-1] for k in (0, 1)]
        t = alignment.Tokens(np.arange(5), *(np.zeros(len(e), np.uint32) for e in ends), *ends, *first)
        groups = alignment.lockstep(t)
        joint = np.intersect1d(*ends)
        assert (ends[0][groups[:, 1] - 1] == joint).all() and (ends[1][groups[:, 3] - 1] == joint).all()
        assert (groups[1:, 0] == groups[:-1, 1]).all() and (groups[1:, 2] == groups[:-1, 3]).all()


def test_wide_groups_are_counted_by_ids():
    n = 100
    t = alignment.Tokens(
        np.arange(1), np.tile([3, 4], n // 2).astype(np.uint32), np.full(n, 9, np.uint32),
        np.append(np.arange(1, 2 * n - 1, 2), 2 * n), np.append(np.arange(2, 2 * n - 1, 2), 2 * n), np.zeros(1, int), np.zeros(1, int),
    )
    groups = alignment.lockstep(t)
    assert groups.tolist() == [[0, n, 0, n]] and n * n > alignment.WIDE
    doc, codes, times = alignment.linked_ids(t, groups, np.zeros(1, np.int64), 10)
    assert doc.tolist() == [0, 0] and codes.tolist() == [39, 49] and times.tolist() == [n * n // 2] * 2


def test_packed_pairs_come_back():
    codes = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 500))
    times = np.arange(1, len(codes) + 1)
    assert [x.tolist() for x in alignment.unpack(alignment.pack(codes, times))] == [codes.tolist(), times.tolist()]


@needs_files
@needs_data
def test_align_query_on_its_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip((r["doc_id"] for r in docs), counts_by_hand(groups_by_hand([r["text"] for r in docs]))))
    rows = queries.op11_align(spark, FOLDER).collect()
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in rows} == want and len(rows) == len(docs)


# Runs


def runs_by_hand(words):
    n, out = len(words), set()
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            part = words[i - q : j]
            if len(part) >= max(6, 4 * q) and not any(part[d:] == part[:-d] for d in range(1, q)):
                out.add((i - q, len(part), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed_by_hand(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]


def repetitive(rng, n):
    texts = []
    for _ in range(n):
        size, kinds = rng.randint(0, 90), rng.choice([1, 2, 3, 5, 50])
        words = [str(rng.randint(1, kinds)) for _ in range(size)]
        if size > 6 and rng.random() < 0.6:
            a = rng.randrange(size)
            p = rng.randint(1, max(1, (size - a) // 3))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(size)]
        if rng.random() < 0.3:
            words += ["x", "y", "z"] + words
        texts.append(" \n".join(words))
    return texts


def test_runs_equal_the_definition():
    texts = repetitive(random.Random(9), 1500)
    for text, (runs, rest) in zip(texts, periodicity.runs_of([t.encode() for t in texts])):
        words = text.split()
        assert runs == runs_by_hand(words)
        assert rest.decode().split() == collapsed_by_hand(words, runs)


def test_one_word_without_end_and_nested_repetition():
    many = ["a"] * 30_000
    nested = (["x"] * 8 + ["y"]) * 5
    (one, rest), (inner, _) = periodicity.runs_of([" ".join(many).encode(), " ".join(nested).encode()])
    assert one == [(0, 30_000, 1)] and rest == b"a"
    assert inner == runs_by_hand(nested) and (0, 45, 9) in inner and (0, 8, 1) in inner


def test_runs_of_a_table(spark):
    texts = [None, "", "  \n", "a b c", "na na na na na na na", "\xa0x " * 9, "é é é é é é"]
    out = periodicity.with_runs(table(spark, texts).withColumnRenamed("doc_id", "_periodic"))
    rows = {r["row"]: r for r in out.collect()}
    assert out.columns == ["_periodic", "text", "row", "runs", "collapsed"] and len(rows) == len(texts)
    for i, text in enumerate(texts):
        words = (text or "").encode().split()
        runs = runs_by_hand(words)
        assert [tuple(r) for r in rows[i]["runs"]] == runs
        assert rows[i]["collapsed"].encode().split() == collapsed_by_hand(words, runs)
    assert periodicity.with_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def edited_by_hand(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


@needs_data
def test_runs_query_on_its_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    rows = {r["doc_id"]: r for r in queries.op12_runs(spark, FOLDER).collect()}
    assert len(rows) == len(docs)
    found = 0
    for doc_id, text in docs:
        words = edited_by_hand(doc_id, (text or "").encode().split())
        runs, row = runs_by_hand(words), rows[doc_id]
        found += len(runs)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        milli = 1000 * best[1] // best[2] if runs else None
        assert (row["n_runs"], row["start"], row["length"], row["period"], row["exponent_milli"]) == (len(runs), *best, milli)
        lines = "".join("%d,%d,%d\n" % r for r in runs)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        rest = b" ".join(collapsed_by_hand(words, runs))
        assert row["collapsed_sha256"] == hashlib.sha256(rest).hexdigest()
    assert found > 10


# Packing


def fewest_bins(items, capacity):
    items, best = sorted(items, reverse=True), len(items)

    def put(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= items[i]}.values():
            put(i + 1, rooms[:j] + [rooms[j] - items[i]] + rooms[j + 1 :])
        put(i + 1, [*rooms, capacity - items[i]])

    put(0, [])
    return best


def test_bin_completion_is_optimal_on_small_input():
    rng = random.Random(2)
    improved = 0
    for _ in range(250):
        capacity = rng.choice([10, 20, 50, 100])
        items = [rng.randint(capacity // 6 + 1, capacity // 2 + 1) for _ in range(rng.randint(1, 11))]
        counts = Counter(items)
        packed = bin_completion.bin_completion(counts, capacity)
        got = Counter()
        for pattern, bins in packed:
            assert sum(s * n for s, n in pattern) <= capacity
            for s, n in pattern:
                got[s] += n * bins
        least = fewest_bins(items, capacity)
        assert got == counts and sum(n for _, n in packed) == least >= bin_completion.lower_bound(counts, capacity)
        improved += least < sum(n for _, n in bin_completion.best_fit(counts, capacity))
    assert improved


def test_search_improves_best_fit_with_copies():
    # Best fit puts two of 4 together and three of 3; the search works on counts, so copies cost nothing.
    counts = {4: 2_000_000, 3: 4_000_000}
    assert sum(n for _, n in bin_completion.best_fit(counts, 10)) == 2_333_334
    packed = bin_completion.bin_completion(counts, 10)
    assert packed == [(((4, 1), (3, 2)), 2_000_000)]


def ids_by_hand(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    return [t.encode(x or "", add_special_tokens=False).ids + [1] for x in texts]


@needs_files
def test_packing_keeps_every_token(spark):
    texts = odd_texts(200) + ["long words here " * 400, "x<|endoftext|>y", "same"] + ["same"] * 30
    docs = table(spark, texts)
    capacity = 300
    ids = ids_by_hand(texts)
    packed = packing.pack(docs.withColumn("doc_id", docs["row"]), WORDS, capacity, with_ids=True)
    rows = packed.collect()
    seen, places = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r["ids"] == ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        seen[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, own in enumerate(ids):
        starts = range(0, len(own), capacity)
        assert sorted(seen[i]) == [(k, s, min(capacity, len(own) - s)) for k, s in enumerate(starts)]
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    counts = Counter(r["length"] for r in rows)
    assert len(places) == bin_completion.lower_bound(counts, capacity)
    whole = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    assert sum(len(r["ids"]) for r in whole.values()) == sum(map(len, ids))
    for r in rows:
        assert whole[r["sequence_id"]]["ids"][r["offset"] : r["offset"] + r["length"]] == r["ids"]


@needs_files
def test_packing_edges(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), WORDS).count() == 0
    docs = spark.createDataFrame([(None, None)] * 3 + [(5, ""), (5, "one"), (5, "one")], "doc_id int, text string")
    rows = packing.pack(docs, WORDS).collect()
    assert Counter(r["doc_id"] for r in rows) == {None: 3, 5: 3}
    assert sorted(r["offset"] for r in rows) == [0, *np.cumsum(sorted(r["length"] for r in rows)[::-1])[:-1]]


@needs_files
@needs_data
def test_pack_query_on_its_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    ids = dict(zip((r["doc_id"] for r in docs), ids_by_hand([r["text"] for r in docs])))
    rows = queries.op13_pack(spark, FOLDER).collect()
    want = {
        (i, k, s, len(own[s : s + 4096]), zlib.crc32(np.array(own[s : s + 4096], "<u4").tobytes()))
        for i, own in ids.items()
        for k, s in enumerate(range(0, len(own), 4096))
    }
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    assert len(rows) == len(want)
    counts = Counter(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) == bin_completion.lower_bound(counts, 4096)


def test_plain_words_and_signs_have_the_librarys_ids():
    from array import array

    from tokenizers import Tokenizer

    with open(f"{queries.TOKENIZERS}/word_bpe_49k.json", encoding="utf-8") as file:
        spec = file.read()
    tokenizer = Tokenizer.from_str(spec)
    tokenizer.encode_special_tokens = False
    encoder = subwords.bpe_encoder(spec, subwords.folded_words, specials_are_text=False)
    texts = ["Plain WORDS, here.", "a . , b!! c", "it's x1 naïve? É, ß.", "", "supercalifragilistic: qzx;", "İx K"]
    for _ in range(2):
        for text, raw in zip(texts, encoder.encode(texts)):
            assert list(array("I", raw)) == tokenizer.encode(text, add_special_tokens=False).ids
    assert subwords.id_bytes([1, 0x01020304]) == b"\x01\x00\x00\x00\x04\x03\x02\x01"
