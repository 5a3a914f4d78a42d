import random

import pytest
from pyspark.sql import functions as F

from cartwright.llm import language, quality
from cartwright.llm.common import sample_per_class

DOCS = "doc_id long, text string, score string"


def _texts(count, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        good = i % 4 != 0
        words = ["".join(rng.choice("abcdeo") for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(30, 90))]
        rows.append((i, " ".join(words) if good else "!! ".join(words).upper() + "!!", int(good)))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = _texts(400)
    documents = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 1), (3, None), (10**9, 0)], "doc_id long, quality int")
    return quality.fit(documents, labels)


def test_classifier_tells_labels_apart_on_unseen_texts(spark, model):
    rows = _texts(120, seed=2)
    documents = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], DOCS)
    scored = quality.with_score(documents, model, "quality_score").collect()
    right = sum((r["quality_score"] >= 0.3) == bool(rows[r["doc_id"]][2]) for r in scored)
    assert right >= 115
    assert scored[0].asDict().keys() == {"doc_id", "text", "score", "quality_score"}


def test_classifier_edges(spark, model):
    documents = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (None, "word", "x"), (4, "word " * 300_000, "x"), (4, "a", "y"), (4, "a", "y")],
        "doc_id long, text string, _gap string",
    )
    scored = quality.with_score(documents, model).collect()
    assert len(scored) == 6 and all(0 <= r["score"] <= 1 for r in scored)
    assert scored[0]["score"] == scored[1]["score"] >= 0.3
    assert scored[4]["score"] == scored[5]["score"]
    assert quality.with_score(documents.limit(0), model).collect() == []


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 1), (2, 0)]])
def test_classifier_without_enough_labels_scores_the_share(spark, labels):
    documents = spark.createDataFrame([(1, "some text", "x"), (2, None, "x")], DOCS)
    model = quality.fit(documents, spark.createDataFrame(labels, "doc_id long, quality int"))
    scores = {r["score"] for r in quality.with_score(documents.drop("score"), model).collect()}
    assert len(scores) == 1 and 0 < scores.pop() < 1


def test_sample_is_bounded_and_repeatable(spark):
    rows = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 20 == 0).cast("int").alias("c"))
    one = {tuple(r) for r in sample_per_class(rows, "c", "k", 100, "s").collect()}
    assert one == {tuple(r) for r in sample_per_class(rows.repartition(7), "c", "k", 100, "s").collect()}
    assert sum(c for _, c in one) == 100 and len(one) == 200


def _speech(rng, letters, words):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(words))


@pytest.fixture(scope="module")
def languages(spark):
    rng = random.Random(3)
    rows = [(i, _speech(rng, "aeioultn" if i % 2 else "kzwyszcä", 40), "aa" if i % 2 else "bb") for i in range(60)]
    rows += [(900, "noise", None), (None, "noise", "aa"), (901, None, "bb")]
    return language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_languages_are_recognised(spark, languages):
    rng = random.Random(4)
    rows = [(i, _speech(rng, "aeioultn" if i % 2 else "kzwyszcä", rng.randint(1, 30))) for i in range(60)]
    judged = language.with_language(spark.createDataFrame(rows, "doc_id long, text string"), languages).collect()
    assert languages.names == ["aa", "bb"]
    assert sum(r["lang_pred"] == ("aa" if r["doc_id"] % 2 else "bb") for r in judged) >= 58
    assert all(0 <= r["score"] <= 1 for r in judged)


def test_language_edges(spark, languages):
    rows = [(1, None, 1), (2, "", 1), (3, "12 34 -", 1), (4, "A", 1), (4, "A", 1), (5, "tun " * 200_000, 1)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, _judged int")
    judged = language.with_language(documents, languages).collect()
    assert [r["lang_pred"] for r in judged[:3]] == ["und"] * 3 and judged[0]["score"] == 0
    assert judged[3]["lang_pred"] in ("aa", "bb") and judged[3] == judged[4]
    assert language.with_language(documents.limit(0), languages).collect() == []
    nothing = language.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r["lang_pred"] for r in language.with_language(documents, nothing).collect()} == {"und"}


def test_ranks_count_grams_of_one_to_three_letters():
    grams, counts = language.ranked_grams("Ab ab")
    code = lambda s: sum(ord(c) << 21 * (len(s) - 1 - i) for i, c in enumerate(s))
    expected = {"a": 2, "b": 2, " a": 2, "ab": 2, "b ": 2, " ab": 2, "ab ": 2, "b a": 1}
    assert dict(zip(grams.tolist(), counts.tolist())) == {code(s): n for s, n in expected.items()}
    assert counts.tolist() == sorted(counts.tolist(), reverse=True)


def test_out_of_place_distance_by_hand():
    import numpy as np

    order = language.ranked_grams("ab")[0]
    ranks = np.full((len(order), 2), language.PROFILE)
    for rank, gram in enumerate(order):
        ranks[np.searchsorted(np.sort(order), gram), 0] = rank
    model = language.LanguageModel(["own", "none"], np.sort(order), ranks)
    assert model.judge("ab") == ("own", 1.0)
    # Nothing in common: both at the largest distance, so the first name.
    assert model.judge("xyz") == ("own", 0.0)
