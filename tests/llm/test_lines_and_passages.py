import hashlib
import random
import re
from collections import defaultdict

import numpy as np

from cartwright.llm import bloom, decontaminate, line_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _dedup_by_hand(rows):
    """rows: (doc_id, text); ids may be None."""
    last = float("inf")
    order = lambda i: last if i is None else i
    holders = defaultdict(set)
    split = [(i, (t or "").split("\n")) for i, t in rows]
    key = lambda s: s.translate(LOWER).strip(" \t\n\r\x0b\x0c")
    for i, lines in split:
        for s in lines:
            if len(key(s)) >= 10:
                holders[key(s)].add(order(i))
    out = []
    for i, lines in split:
        kept = [s for s in lines if not (len(holders[key(s)]) > 1 and min(holders[key(s)]) != order(i))]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def _dedup(spark, rows, columns="doc_id long, text string"):
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, columns)).collect()
    return sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in found), key=str)


def test_line_dedup_takes_one_python_step_under_a_filter(spark):
    rows = [(i, f"A line of several documents\nline {i}") for i in range(20)]
    kept = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    left = kept.filter("n_dropped > 0 AND text <> ''")
    plan = left._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert left.count() == 19


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(5)
    pool = [f"Line number {i} of the pool" for i in range(40)] + ["short", "ÄÖÜ ÄÖÜ éé", "ÄÖÜ ÄÖÜ é", "  Padded Line here\t", ""]
    rows = [(i, "\n".join(rng.choice(pool).swapcase() if rng.random() < 0.3 else rng.choice(pool) for _ in range(rng.randint(1, 9)))) for i in range(120)]
    assert _dedup(spark, rows) == _dedup_by_hand(rows)


def test_line_dedup_edges(spark):
    line = "a line that is long enough"
    rows = [(1, None), (2, ""), (3, line), (3, line), (4, f"{line}\r\n{line.upper()}"), (None, f"x\n{line}"), (None, "only without an id"),
            (None, "only without an id"), (7, "\n".join(["own line of a long text"] * 20000)), (8, f"own line of a long text\n{line}\n")]
    assert _dedup(spark, rows) == _dedup_by_hand(rows)
    assert _dedup(spark, []) == []
    extra = spark.createDataFrame([(2, line, 5, "k"), (1, line, 6, "m")], "doc_id long, text string, _lines int, _of string")
    out = {r["doc_id"]: r for r in line_dedup.dedup_lines(extra).collect()}
    assert out[1]["text"] == line and out[2]["text"] == "" and out[2]["_lines"] == 5 and out[2]["_of"] == "k"


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    """Far too small a filter suspects nearly every line; the confirmation still decides."""
    monkeypatch.setattr(line_dedup, "filter_bits", lambda lines: bloom.STRETCH * 8)
    rows = [(i, f"line of document {i} only\nline of a pair {i // 2} of them\n" + "\n".join(f"filler {i} {j} of many" for j in range(1500))) for i in range(60)]
    assert _dedup(spark, rows) == _dedup_by_hand(rows)


def test_twice_filter_finds_every_repeat(spark):
    def hashes(batch):
        return batch.column(0).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    ids = spark.range(0, 3000, 1, 5).union(spark.range(2500, 4000, 1, 3))
    found = bloom.seen_twice(ids, hashes, bloom.filter_bits(4500))
    hit = bloom.contains(found, np.arange(4000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    assert hit[2500:3000].all() and hit.mean() < 0.2


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _hits_by_hand(texts, items):
    words = lambda t: WORD.findall((t or "").translate(LOWER))
    windows = defaultdict(set)
    for name, text in items:
        w = words(text)
        size = min(10, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            windows[tuple(w[i : i + size])].add(name)
    out = []
    for i, text in texts:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for at in range(len(w) - size + 1):
                names = windows.get(tuple(w[at : at + size]))
                if names:
                    hit.update(range(at, at + size))
                    found |= {str(n) for n in names if n is not None}
        out.append((i, len(w), len(hit), sorted(found), bool(hit)))
    return sorted(out, key=str)


def _hits(spark, texts, items):
    out = decontaminate.with_matches(
        spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in out), key=str)


def _passages(seed):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "GAMMA", "dél", "x1", "y", "zeta", "été"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 5, 9, 10, 11, 14, 30]))) for i in range(8, 14)]
    texts = []
    for i in range(60):
        parts = [text(rng.randint(0, 30))]
        if rng.random() < 0.6:
            whole = rng.choice(items)[1].split(" ")
            at = rng.randint(0, max(0, len(whole) - 3))
            parts += [" ".join(whole[at:]).upper(), text(5)]
        texts.append((i, " ".join(parts)))
    return texts, items


def test_decontamination_matches_brute_force(spark):
    for seed in range(3):
        texts, items = _passages(seed)
        assert _hits(spark, texts, items) == _hits_by_hand(texts, items)


def test_decontamination_in_parts_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PART_WORDS", 12)
    texts, items = _passages(7)
    items.append((99, " ".join(f"w{i}" for i in range(60))))
    texts.append((777, "before " + " ".join(f"w{i}" for i in range(5, 45)) + " after"))
    assert _hits(spark, texts, items) == _hits_by_hand(texts, items)


def test_decontamination_edges(spark):
    ten = "one two three four five six seven eight nine ten"
    texts = [(1, None), (2, ""), (None, ten), (4, ten), (4, ten), (5, "... !!"), (6, f"{ten} " * 5000)]
    items = [(1, ten), (1, "other words entirely"), (None, "one two three four five six seven eight nine ten"), (3, None), (4, ""), (5, "?"), (2, ten)]
    assert _hits(spark, texts, items) == _hits_by_hand(texts, items)
    assert _hits(spark, texts, []) == _hits_by_hand(texts, [])
    assert _hits(spark, [], items) == []
    named = spark.createDataFrame([(1, ten, 7, "z")], "doc_id long, text string, _found int, spans string")
    row = decontaminate.with_matches(named, spark.createDataFrame(items, "item_id long, text string")).first()
    assert row["_found"] == 7 and row["spans"] == "z" and row["n_hit"] == 10 and row["items"] == ["1", "2"]


def test_search_jumps():
    words = [f"w{i}".encode() for i in range(1000)]
    search = decontaminate.WuManber({tuple(words[500:510]): [0]})
    looked = []
    shift = search.shift
    search.shift = type("Counted", (dict,), {"get": lambda s, k, d: looked.append(k) or dict.get(s, k, d)})(shift)
    assert list(search.search(words)) == [(500, 510, [0])]
    assert len(looked) < 1000 / 8


def test_lines_are_whole_in_the_digest(spark):
    rows = [(1, "keep me as I am  \n\nand me\r"), (2, "x")]
    out = {i: t for i, t, *_ in _dedup(spark, rows)}
    assert hashlib.sha256(out[1].encode()).digest() == hashlib.sha256(rows[0][1].encode()).digest()
