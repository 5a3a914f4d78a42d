"""Registered queries against SQL on the smallest tables, and the pipeline on a small corpus."""

import os
import random

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from cartwright.llm.oracles import ORACLES
from cartwright.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.exists(FOLDER), reason="no tables here")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in ("documents", "labels", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_all_are_registered():
    names = set(__spark_entry__.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {n for n in names if n.startswith("op")} == set(QUERIES) and len(QUERIES) == 13
    assert set(ORACLES) <= set(QUERIES)


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sql, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    want = sql.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})")
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want.fetchall()))


@needs_data
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_keeps_every_row(spark, sql, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    ids = [i for (i,) in sql.sql("SELECT doc_id FROM documents").fetchall()]
    found = [r["doc_id"] for r in rows if name != "op13_pack" or r["piece"] == 0]
    assert sorted(found) == sorted(ids)


@needs_data
def test_fingerprint_query_by_hand(spark, sql):
    import hashlib

    from test_native import _text_of, _winnow

    docs = sql.sql("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()
    rows = {r["doc_id"]: r for r in QUERIES["op4_fingerprints"](spark, FOLDER).collect()}
    prints = {i: _winnow(t, 3, 4) for i, t in docs}
    for at, (i, text) in enumerate(docs):
        following = docs[(at + 1) % len(docs)]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[1][:half]
        row = rows[i]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["fingerprint"] == _text_of(prints[i])
        assert row["edited_fingerprint"] == _text_of(_winnow(edited, 3, 4))
        a, b = ({h for h, _ in prints[j]} for j in (i, following[0]))
        assert row["near_next"] == pytest.approx(len(a & b) / len(a | b))


@needs_data
def test_language_query_on_the_held_out_fold(spark, sql):
    lang = dict(sql.sql("SELECT doc_id, lang FROM documents").fetchall())
    rows = [r for r in QUERIES["op7_language"](spark, FOLDER).collect() if r["held_out"]]
    assert len(rows) > 30 and sum(r["lang_pred"] == lang[r["doc_id"]] for r in rows) >= 0.95 * len(rows)


def _corpus(spark, folder):
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(900)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    item = prose(40)
    rows, labels = [], []
    for i in range(300):
        bad = i % 5 == 4
        text = "\n".join(prose(30) for _ in range(4))
        rows.append([i, "$$$ ".join(text.upper().split(" ")) if bad else text, "en", f"s{i % 4}", len(text)])
        labels.append((i, int(not bad), 0))
    shared = "the very same line in three documents of the corpus"
    for i in (10, 21, 33):
        rows[i][1] += "\n" + shared
    rows[50][1] = rows[40][1]
    rows[61][1] = rows[60][1] + " " + prose(3)
    rows[71][1] += "\n" + prose(10) + " " + " ".join(item.split()[3:25]) + " " + prose(5)
    rows += [[300, None, None, None, None], [301, "", "en", None, 0]]
    rows = [(*r, "extra") for r in rows]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return {r[0]: r[1] for r in rows}, shared


def test_pipeline_takes_out_what_each_stage_is_for(spark, tmp_path):
    folder = str(tmp_path)
    texts, shared = _corpus(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if n < 4:
            assert out.columns == corpus_pipeline.COLUMNS
        out.write.parquet(f"{folder}/out-{n}")
        docs = spark.read.parquet(f"{folder}/out-{n}")
        kept[n] = {r["doc_id"]: r for r in docs.collect()}
    good = {i for i in range(300) if i % 5 != 4}
    assert len(good - set(kept[0])) <= 2 and len(set(kept[0]) & set(range(300)) - good) <= 4
    # 50 loses all its lines to 40.
    assert set(kept[1]) == set(kept[0]) - {50}
    assert [shared in kept[1][i]["text"] for i in (10, 21, 33)] == [True, False, False]
    assert kept[1][21]["n_chars"] == len(kept[1][21]["text"])
    # 61 lost the lines it shares with 60, and is no copy any more.
    assert set(kept[1]) == set(kept[2])
    assert set(kept[2]) - set(kept[3]) == {71}
    taken = [r for r in kept[4].values()]
    assert taken and all(0 < r["taken"] <= 3 * r["size"] for r in taken) and set(kept[4]) <= set(kept[3])
    run = {(r["doc_id"], r["taken"]) for r in corpus_pipeline.run(spark, folder).collect()}
    assert run == {(r["doc_id"], r["taken"]) for r in taken}


def test_stages_on_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    empty = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], empty).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []
