import os
import random

import pytest

from cartwright.llm import ngram_join, token_counts
from cartwright.llm.components import components
from cartwright.sources.scratch import Scratch


def _sets(text, n):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    size = min(n, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if size else set()


def _alike_by_hand(rows, n, num, den):
    sets = [(i, _sets(t, n)) for i, t in rows]
    ids = {i for i, _ in rows}
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, x in sets:
        for b, y in sets:
            if x and y and den * len(x & y) >= num * len(x | y):
                low, high = sorted((find(a), find(b)), key=lambda i: (i is None, i or 0))
                parent[high] = low
    return sorted(((i, len(s), find(i)) for i, s in sets), key=str)


def _alike(spark, rows, n=5, num=80, den=100):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = ngram_join.similar_documents(df, n, num, den).collect()
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out), key=str)


def _family(rng, start, size, words, edits):
    base = [f"w{rng.randint(0, 400)}" for _ in range(words)]
    rows = []
    for k in range(size):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(words)] = f"e{rng.randint(0, 10**6)}"
        rows.append((start + k, " ".join(text)))
    return rows


@pytest.mark.parametrize("n,num", [(4, 85), (2, 50)])
def test_components_match_brute_force(spark, n, num):
    rng = random.Random(num)
    rows = _family(rng, 1000, 40, 60, 4) + _family(rng, 2000, 30, 120, 8) + _family(rng, 3000, 25, 12, 2) + _family(rng, 4000, 10, 3, 1)
    # A chain: each shares most with the one before, the ends share nothing.
    rows += [(5000 + i, " ".join(f"c{j}" for j in range(i * 4, i * 4 + 80))) for i in range(20)]
    # One passage in texts that are otherwise apart.
    passage = " ".join(f"p{j}" for j in range(60))
    rows += [(6000 + i, passage + " " + " ".join(f"q{i}x{j}" for j in range(rng.randint(5, 40)))) for i in range(30)]
    rng.shuffle(rows)
    assert _alike(spark, rows, n, num) == _alike_by_hand(rows, n, num, 100)


def test_large_group_of_near_copies_is_one_class(spark):
    rng = random.Random(9)
    rows = _family(rng, 0, 500, 100, 2)
    assert {c for _, _, c in _alike(spark, rows)} == {0}


def test_join_edges(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "à b"), (8, "À b"), (9, long), (10, long + " more"),
            (11, "same text for one id here"), (11, "same text for one id here"), (12, "first text of an id that has two"), (12, "one"), (None, "no id at all in here"), (14, "no id at all in here")]
    assert _alike(spark, rows) == _alike_by_hand(rows, 5, 80, 100)
    assert _alike(spark, []) == []
    assert _alike(spark, [(1, None)]) == [(1, 0, 1)]
    extra = spark.createDataFrame([(1, "a b c", 2, "x")], "doc_id long, text string, n int, component string")
    assert ngram_join.similar_documents(extra).count() == 1


def test_contraction_of_chains_stars_and_rings(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(2000 + i, 2000 + (i + 1) % 50) for i in range(50)] + [(7, 7)]
    ids = {i for e in edges if e[0] != e[1] for i in e}
    rng.shuffle(edges)
    out = components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()
    assert {r["node"]: r["component"] for r in out} == {i: 0 if i <= 300 else i // 1000 * 1000 for i in ids}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark)).collect() == []


def test_filters_never_lose_a_pair(spark):
    """Prefixes of alike sets meet, whatever the order."""
    for n in range(1, 60):
        for m in range(n, 60):
            need = -(-80 * (n + m) // 180)
            if need <= n and m * 80 <= n * 100:
                first = lambda s: s - -(-80 * s // 100) + 1
                # The shared elements can all lie outside a prefix only if fewer than needed are left.
                assert n - first(n) < need or m - first(m) < need
                assert n - first(n) + 1 <= need


def _greedy(pieces, word):
    at = n = 0
    longest = max(map(len, pieces))
    while at < len(word):
        for size in range(min(longest, len(word) - at), 0, -1):
            if word[at : at + size] in pieces:
                at, n = at + size, n + 1
                break
        else:
            return 1
    return n


def test_automaton_counts_greedy_pieces():
    rng = random.Random(3)
    for _ in range(200):
        letters = b"ab" if rng.random() < 0.5 else b"abc"
        pieces = {bytes(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 12))}
        if rng.random() < 0.6:
            pieces |= {bytes([c]) for c in letters}
        automaton = token_counts.Automaton(sorted(pieces))
        for _ in range(60):
            word = bytes(rng.choice(letters) for _ in range(rng.randint(1, 25)))
            assert automaton.count(word) == _greedy(pieces, word), (pieces, word)


def test_token_counts_of_documents(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED_WORDS", 3)
    pieces = [bytes([c]) for c in range(256)] + [b" the", b" th", b"ing", b"in", b" s", b"\xc3\xa9"]
    rows = [(1, "the sing"), (2, None), (3, ""), (None, "thé\tthe\n\nthe"), (5, "x" * 100_000), (5, "x" * 100_000), (6, "a b c d e f")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as _counted", "2 as n_tokens")
    found = token_counts.with_token_counts(df, pieces).collect()
    by_hand = [sum(_greedy(set(pieces), b" " + w) for w in (t or "").encode().split()) for _, t in rows]
    assert [r["n_tokens"] for r in found] == by_hand
    assert [r["n_words"] for r in found] == [len((t or "").split()) for _, t in rows]
    assert token_counts.with_token_counts(df.limit(0), pieces).collect() == []


@pytest.mark.skipif(not os.path.exists(token_counts.VOCABULARY), reason="no vocabulary here")
def test_public_vocabulary():
    pieces = token_counts.read_vocabulary()
    automaton, known = token_counts.Automaton(pieces), set(pieces)
    for word in (b" the", b" internationalisation", " naïveté".encode(), b" \xff\xfe", b" aaaaaaaaaaaaaaaab"):
        assert automaton.count(word) == _greedy(known, word)
