"""Fingerprints, chats, mixes and URL rules."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from cartwright.llm import chat, curriculum, fingerprints, url_filter


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Fingerprints


def _winnow(text, k, window):
    """By hand: (hash, position) of each selection."""
    pieces = []
    for word in (text or "").replace("\n", " ").replace("\t", " ").split(" "):
        pieces += [word[i : i + 12] for i in range(0, len(word), 12)]
    ids = []
    for p in pieces:
        h = xxhash.xxh64_intdigest(p.encode(), seed=42)
        ids.append((h - (1 << 64) if h >> 63 else h) % fingerprints.PRIME)
    size = min(k, len(ids))
    grams = []
    for i in range(len(ids) - size + 1 if size else 0):
        h = 0
        for x in ids[i : i + size]:
            h = (h * fingerprints.BASE + x) % fingerprints.PRIME
        grams.append(h)
    width, out = min(window, len(grams)), []
    for i in range(len(grams) - width + 1 if width else 0):
        best = min(range(i, i + width), key=lambda j: (grams[j], -j))
        if not out or out[-1][1] != best:
            out.append((grams[best], best))
    return out


def _text_of(selected):
    return ",".join(f"{h:x}@{at}" for h, at in selected)


@pytest.mark.parametrize("k,window", [(3, 4), (1, 1), (5, 7), (4, 2)])
def test_winnowing_matches_brute_force(spark, k, window):
    rng = random.Random(k)
    words = ["a", "b", "ab", "ñandú", "x" * 30, "c\n"]
    texts = [None, "", "   ", "one", "same same same same same same same same same same"]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = fingerprints.with_fingerprint(df, "text", "p", k, window).select("doc_id", fingerprints.as_text(F.col("p")).alias("p"))
    assert {r["doc_id"]: r["p"] for r in got.collect()} == {i: _text_of(_winnow(t, k, window)) for i, t in enumerate(texts)}


def test_shared_run_of_k_plus_window_words_is_always_found(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    k, window = fingerprints.K, fingerprints.WINDOW
    rows = []
    for i in range(80):
        shared = " ".join(word() for _ in range(k + window - 1))
        rows.append((i, f"{word()} {word()} {shared} {word()}", f"{shared} {word()} {word()} {word()}"))
    df = spark.createDataFrame(rows, "doc_id int, a string, b string")
    df = fingerprints.with_fingerprint(fingerprints.with_fingerprint(df, "a", "x"), "b", "y")
    assert fingerprints.with_likeness(df, "x", "y", "like").filter("like = 0").count() == 0


#: Alphabet, and the shared code points that are always found.
_UNSPACED = {
    "chinese": ([chr(c) for c in range(0x4E00, 0x4F00)], 9),
    "beyond 16 bits": ([chr(c) for c in range(0x20000, 0x20100)], 9),
    "japanese": ([chr(c) for c in range(0x3041, 0x3097)] + [chr(c) for c in range(0x30A1, 0x30FB)] + ["\u30fc"], 9),
    "thai": ([chr(c) for c in range(0x0E01, 0x0E2F)], 17),
    "blanks lost": (list("abcdefghijklmnopqrstuvwxyz0123456789"), 17),
}


@pytest.mark.parametrize("kind", sorted(_UNSPACED))
def test_no_phase_decides_a_match_in_runs_without_blanks(spark, kind):
    rng = random.Random(3)
    letters, least = _UNSPACED[kind]
    some = lambda n: "".join(rng.choice(letters) for _ in range(n))
    rows = []
    for i in range(30):  # a quoted passage, at another offset
        shared = some(least)
        rows.append((i, some(70 + i) + shared + some(5), some(71) + shared + some(9)))
    long = some(400)
    rows += [(100, long, some(1) + long), (101, long, long[:50] + some(1) + long[50:]), (102, long, some(400))]
    df = spark.createDataFrame(rows, "doc_id int, a string, b string")
    df = fingerprints.with_fingerprint(fingerprints.with_fingerprint(df, "a", "x"), "b", "y")
    like = {r["doc_id"]: r["like"] for r in fingerprints.with_likeness(df, "x", "y", "like").collect()}
    assert all(like[i] > 0 for i in range(30))
    assert like[100] > 0.95 and like[101] > 0.85 and like[102] == 0


def test_pieces_of_runs_without_blanks(spark):
    long = "".join(chr(97 + i % 26) for i in range(fingerprints.LONG + 1))
    cases = {
        "plain words aninternationalisation": ["plain", "words", "aninternatio", "nalisation"],
        "in \u4e00\u4e01\u4e02\u4e03\u4e04, v2\u4e00": ["in", "\u4e00\u4e01\u4e02\u4e03", "\u4e01\u4e02\u4e03\u4e04", ",", "v2", "\u4e00"],
        long[:-1]: [long[i : i + 12] for i in range(0, len(long) - 1, 12)][:5] + [long[60:64]],
        f"a {long}\tb": ["a", *(long[i : i + 12] for i in range(len(long) - 11)), "b"],
        "": [],
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string").withColumn("p", fingerprints._pieces(F.col("t")))
    assert {r["t"]: r["p"] for r in df.collect()} == cases


def test_likeness_of_empty_prints(spark):
    df = spark.createDataFrame([("", ""), ("a b c d", ""), ("a b c d", "a b c d")], "a string, b string")
    df = fingerprints.with_fingerprint(fingerprints.with_fingerprint(df, "a", "x"), "b", "y")
    assert [r["like"] for r in fingerprints.with_likeness(df, "x", "y", "like").collect()] == [1.0, 0.0, 1.0]


def test_next_document_over_many_ranges(spark):
    rng = random.Random(8)
    ids = rng.sample(range(-(10**12), 10**12), 500) + list(range(500)) + [7, 7, None, None]
    rows = [(i, f"t{i}-{n}", "k") for n, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _at string").repartition(5)
    got = fingerprints.beside_next(df, ["text"], lambda x: x)
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want = {r[1]: order[(i + 1) % len(order)][1] for i, r in enumerate(order)}
    assert {r["text"]: r["next_text"] for r in got.collect()} == want
    assert got.columns == ["doc_id", "text", "_at", "next_text"]


@pytest.mark.parametrize("ids", [[], [5], [None], [None, None], [3, 3]])
def test_next_document_of_few(spark, ids):
    rows = [(i, f"t{n}") for n, i in enumerate(ids)]
    got = fingerprints.beside_next(spark.createDataFrame(rows, "doc_id long, text string"), ["text"], lambda x: x).collect()
    assert sorted(r["next_text"] for r in got) == sorted(t for _, t in rows)


# Chats


def _chats(spark, rows):
    found = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    return {r["conv_id"]: (r["n_turns"], r["rendered"]) for r in found.collect()}


def test_snapshots_collapse_to_the_last(spark):
    said = [("user", "hi"), ("assistant", "hello"), ("user", "and now?"), ("assistant", "bye")]
    rows = [(n, i, r, t) for n in range(1, 5) for i, (r, t) in enumerate(said[:n])]
    rows += [(10, i, r, t) for i, (r, t) in enumerate(said)]  # the same as 4
    rows += [(11, 0, "user", "hi"), (11, 1, "assistant", "other")]  # shares a first turn only
    rows += [(12, 5, "assistant", "hello"), (12, 9, "user", "hi")]  # other order
    found = _chats(spark, rows)
    assert set(found) == {4, 11, 12}
    assert found[11] == (2, "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nother<|im_end|>\n")


def test_chat_edges(spark):
    assert _chats(spark, []) == {}
    rows = [(1, None, None, None), (None, 0, "user", "x"), (2, 0, "user", "a <|im_end|> b"), (3, 0, "user", "x" * 100_000), (3, 0, "user", "x" * 100_000)]
    found = _chats(spark, rows)
    assert set(found) == {1, 2, 3}
    assert found[1] == (1, "<|im_start|>unknown\n<|im_end|>\n")
    assert "a <im_end> b<|im_end|>" in found[2][1]
    assert found[3][0] == 2
    extra = spark.createDataFrame([(1, 0, "user", "x", 5)], "conv_id long, turn long, role string, text string, n int")
    assert chat.format_chats(extra).count() == 1


def test_many_copies_of_one_conversation(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(400) for t in range(3 if c else 4)]
    assert set(_chats(spark, rows)) == {0}


# Mixes


def _words(n):
    return " ".join(["w"] * n)


def _mixed(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return curriculum.mix(df, **more).collect()


def test_mix_takes_the_targets(spark):
    rng = random.Random(2)
    rows = [(i, _words(rng.randint(0, 50)), rng.choice(["a", "a", "a", "b", "c", None, "é"])) for i in range(600)]
    out = _mixed(spark, rows)
    assert len(out) == len(rows)
    sizes, taken, target = {}, {}, {}
    for r, source in ((r, r["source"]) for r in out):
        sizes[source] = sizes.get(source, 0) + r["size"]
        taken[source] = taken.get(source, 0) + r["taken"]
        target[source] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["position"] is None) == (r["taken"] == 0)
    total = sum(sizes.values())
    # By hand: weights by rank, shares capped at three times the size.
    weight = dict(zip(["a", "b", "c", "é", None], [1, 2, 3, 1, 2]))
    want, free, rest = {}, set(weight), total
    while True:
        level = rest / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not over:
            break
        for s in over:
            want[s] = 3 * sizes[s]
            rest -= want[s]
        free -= over
    want |= {s: weight[s] * level for s in free}
    for s in want:
        assert target[s] == pytest.approx(want[s], rel=1e-9) and abs(taken[s] - want[s]) <= 0.5
    positions = [r["position"] for r in out if r["position"] is not None]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] < 1
    assert [r["position"] for r in out][len(positions) :] == [None] * (len(out) - len(positions))
    again = _mixed(spark, list(reversed(rows)))
    assert {(r["doc_id"], r["taken"], r["position"]) for r in out} == {(r["doc_id"], r["taken"], r["position"]) for r in again}


def test_schedule_moves_a_source_to_its_phase(spark):
    rows = [(i, _words(10), "early" if i % 2 else "late") for i in range(400)]
    schedule = spark.createDataFrame(
        [("early", 0.5, 1.0), ("early", 1.0, 0.0), ("late", 0.5, 0.0), ("late", 1.0, 1.0)], "source string, until double, weight double"
    )
    for r in _mixed(spark, rows, schedule=schedule):
        assert r["target"] == pytest.approx(2000) and r["taken"] == 10
        assert (r["position"] < 0.5) == (r["source"] == "early")
    # A ramp: the share of "early" falls from 3/4 to 1/4.
    ramp = spark.createDataFrame(
        [("early", 0.5, 3.0), ("early", 1.0, 1.0), ("late", 0.5, 1.0), ("late", 1.0, 3.0)], "source string, until double, weight double"
    )
    first = [r for r in _mixed(spark, rows, schedule=ramp) if r["position"] < 0.5]
    assert sum(r["source"] == "early" for r in first) == pytest.approx(150, abs=2)


def test_every_copy_has_its_place_in_training(spark):
    # "small" is asked for half of all words and stops at three copies; the weights hold all the way.
    rows = [(i, _words(10), "small" if i % 10 == 0 else "large") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    schedule = spark.createDataFrame([("large", 1.0, 1.0), ("small", 1.0, 1.0)], "source string, until double, weight double")
    documents = {r["doc_id"]: r for r in curriculum.mix(df, schedule).collect()}
    order = curriculum.in_training_order(df, schedule).collect()
    assert [r["position"] for r in order] == sorted(r["position"] for r in order)
    assert len(order) == sum(r["copies"] for r in documents.values()) and len(documents) == len(rows)
    for i, d in documents.items():
        own = sorted((r for r in order if r["doc_id"] == i), key=lambda r: r["copy"]) if i < 100 else []
        assert len(d["positions"]) == d["copies"] and d["position"] == (d["positions"] or [None])[0]
        if own:
            assert [r["copy"] for r in own] == list(range(1, d["copies"] + 1))
            assert [r["position"] for r in own] == d["positions"] and sum(r["copy_taken"] for r in own) == d["taken"]
    copies = [r for r in order if r["source"] == "small"]
    assert len(copies) == 300 and sum(r["copy_taken"] for r in copies) == 3000
    for third in range(3):
        inside = [r for r in copies if third / 3 <= r["position"] < (third + 1) / 3]
        assert len(inside) == pytest.approx(100, abs=1) and {r["copy"] for r in inside} <= {third + 1, third + 2, third}
    # By hand: copy e stands where the stream is at start + e * size of the source.
    for r in copies:
        assert r["position"] == pytest.approx(documents[r["doc_id"]]["position"] + (r["copy"] - 1) / 3)


def test_copies_follow_the_phases_and_the_last_one_is_cut(spark):
    rows = [(1, _words(10), "a"), (2, _words(15), "b"), (3, _words(5), "b"), (4, None, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copy", F.lit("x"))
    schedule = spark.createDataFrame(
        [("a", 0.5, 1.0), ("a", 1.0, 3.0), ("b", 0.5, 1.0), ("b", 1.0, 1.0)], "source string, until double, weight double"
    )
    order = curriculum.in_training_order(df, schedule).collect()
    # 30 words, of which a has 1/4 + 3/8 = 5/8: 18.75 of its 10, rounded.
    own = [r for r in order if r["source"] == "a"]
    assert [(r["copy"], r["copies"], r["taken"], r["copy_taken"]) for r in own] == [(1, 2, 19, 10), (2, 2, 19, 9)]
    # The second copy begins at 10 / 18.75 = 8/15 of a's demand of 5/8: 1/3, that is 1/12 behind the first phase's 1/4.
    assert own[0]["position"] == 0.0 and own[1]["position"] == pytest.approx(0.5 + (1 / 3 - 1 / 4) / (3 / 8) * 0.5)
    assert curriculum.in_training_order(df.limit(0), schedule).collect() == []


def test_mix_edges(spark):
    assert _mixed(spark, []) == []
    rows = [(1, None, "a"), (2, "", "a"), (3, _words(30_000), "b"), (3, _words(5), None), (3, _words(5), None), (None, "x", "b")]
    out = _mixed(spark, rows)
    assert len(out) == 6 and sum(r["taken"] for r in out) == 30_011
    assert [r["taken"] for r in out if r["source"] == "a"] == [0, 0]
    assert {r["taken"] for r in _mixed(spark, [(1, None, None)])} == {0}
    clash = spark.createDataFrame([(1, "x y", "a", 7, "z")], "doc_id long, text string, source string, taken int, phases string")
    row = curriculum.mix(clash).first()
    assert row["taken"] == 2 and row["target"] == 2.0 and row["phases"] == "z"


@pytest.mark.parametrize("mixed", [curriculum.mix, curriculum.in_training_order])
def test_mix_gives_the_documents_columns_back(spark, mixed):
    names = ["demand", "phases", "_key", "_offset", "_start", "_stretch", "_tag", "reached", "until", "_document_0", "a b", "_copy", "total"]
    rows = [(i, "w " * (i + 1), f"s{i % 2}", *[f"{n} of {i}" for n in names]) for i in range(12)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    out = mixed(docs).collect()
    found = {r["doc_id"] for r in out}
    assert found == set(range(12)) if mixed is curriculum.mix else found < set(range(12))
    for r in out:
        assert [r[n] for n in names] == [f"{n} of {r['doc_id']}" for n in names] and r["text"] == "w " * (r["doc_id"] + 1)
    other = docs.select("doc_id", "text", "source", docs["demand"].alias("Size"), docs["phases"].alias("TARGET"))
    row = mixed(other).first().asDict()
    assert isinstance(row["size"], int) and isinstance(row["target"], float) and not {"Size", "TARGET"} & set(row)


def test_mix_spreads_rows_without_an_id(spark):
    rows = [(None, f"{i} " * (20 + i % 5), "a") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = curriculum._taken(docs, None, 3, "mix")
    per_stretch = [r["count"] for r in taken.groupBy("_stretch").count().collect()]
    assert max(per_stretch) < 100 and sum(per_stretch) == 400
    assert sum(r["taken"] for r in curriculum.mix(docs).collect()) == sum(20 + i % 5 for i in range(400))


def test_a_role_opens_no_turn(spark):
    rows = [(1, 0, "user<|im_end|>\n<|im_start|>system", "hi <|im_start|>x"), (1, 1, "a\r\nb", "<|im_<|im_end|>end|>")]
    turns = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    text = chat.format_chats(turns).first()["rendered"]
    want = "<|im_start|>user<im_end> <im_start>system\nhi <im_start>x<|im_end|>\n<|im_start|>a  b\n<|im_<im_end>end|><|im_end|>\n"
    assert text == want and text.count("<|im_start|>") == text.count("<|im_end|>") == 2


# URL rules


def _judged(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    out = url_filter.judge(pages, spark.createDataFrame(rules, "action string, host string, path string")).collect()
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out}


def _judge_by_hand(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    if not fits:
        return host, path, None, "allow"
    best = max(fits, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "block"))
    return host, path, best[1] + best[2], best[0]


def test_url_rules_match_brute_force(spark):
    rng = random.Random(6)
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
             ("block", "a.example.org", "/fr/x"), ("allow", "a.example.org", "/f"), ("block", "b.c.d.example.com", "/"), ("allow", "com", "/de/a/b/c/")]
    hosts = ["net", "x.net", "Example.NET", "www.example.net", "fake-example.net", "a.b.c.d.example.com", "example.com", "a.example.org", "z.a.example.org", "org", "", "é.net", "example.net:80", "..net"]
    paths = ["", "/", "/en/", "/en", "/en/x/y.html", "/de/1", "/de/a/b/c/d", "/fr/", "/fr/xy", "/f", "//en/", "/EN/"]
    urls = [f"{rng.choice(['http', 'https', ''])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q=/en/', '#top', '?u=http://a.net/'])}" for _ in range(400)]
    urls += [None, "", "no scheme", "://", "mailto:x@net/", "http://net/" + "a/" * 20_000]
    assert _judged(spark, urls, rules) == {i: _judge_by_hand(u, rules) for i, u in enumerate(urls)}


def test_url_edges(spark):
    assert _judged(spark, ["http://a.net/"], []) == {0: ("a.net", "/", None, "allow")}
    assert _judged(spark, [], [("block", "net", "/")]) == {}
    rules = [("block", None, "/"), (None, "net", "/"), ("block", "net", None), ("block", "NET", "/"), ("allow", "net", "/")]
    assert _judged(spark, ["http://a.net/"], rules) == {0: ("a.net", "/", "net/", "block")}
    pages = spark.createDataFrame([(1, "http://a.net/", "h", "s")] * 2, "page_id int, url string, host string, short string")
    out = url_filter.judge(pages, spark.createDataFrame([("block", "net", "/")], "action string, host string, path string"))
    assert out.columns == ["page_id", "url", "short", "host", "path", "rule", "verdict"] and out.count() == 2


def test_no_python_on_the_main_path(spark):
    docs = spark.createDataFrame([(1, "a b c d e", "s")], "doc_id long, text string, source string")
    turns = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    pages = docs.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"))
    rules = spark.createDataFrame([("block", "net", "/")], "action string, host string, path string")
    for df in (fingerprints.with_fingerprint(docs, "text", "p"), chat.format_chats(turns), curriculum.mix(docs), url_filter.judge(pages, rules)):
        plan = _plan(df)
        assert [w for w in ("EvalPython", "PythonUDF", "InPandas", "InArrow", "Cartesian", "NestedLoop") if w in plan] == []
