"""Language by rank-order profiles.

A profile is a list of the most frequent letter n-grams (one to three letters, a blank at word
edges), best first. A document's own list is compared with each language's: every n-gram adds how
far its rank is out of place, or the list's length where the language lacks it. The smallest sum
wins, the smaller language name on a tie.

Profiles are learned from a bounded sample of labelled rows (``sample_docs`` whole documents of
each language, counted on the executors); prediction is one pass without a shuffle.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every text if
nothing could be learned. Rows without a label teach nothing. Repeated rows are judged each;
further columns stay. The score is one minus the smallest sum over the largest possible sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import fresh, sample_per_class
from cartwright.sources.scratch import Scratch

PROFILE = 400
GRAMS = 3
_BLANK = ord(" ")


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ranked_grams(text: str | None, most: int = PROFILE) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent n-grams as numbers, best first, and their counts; ties by number."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    points = np.where(letter, points, _BLANK).astype(np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    points = np.concatenate(([_BLANK], points[keep], [_BLANK] * int(letter[-1]))).astype(np.uint64)
    grams, code = [points[points != _BLANK]], points
    for n in range(1, GRAMS):
        code = (code[:-1] << np.uint64(21)) | points[n:]
        grams.append(code)
    found, counts = np.unique(np.concatenate(grams), return_counts=True)
    best = np.argsort(-counts, kind="stable")[:most]
    return found[best], counts[best]


@dataclass(frozen=True)
class LanguageModel:
    names: list[str]
    grams: np.ndarray  # all n-grams of any profile, sorted
    ranks: np.ndarray  # by n-gram and language; PROFILE where a profile lacks it

    def judge(self, text: str | None) -> tuple[str, float]:
        own, _ = ranked_grams(text)
        if not len(own) or not self.names:
            return "und", 0.0
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        ranks = np.where((self.grams[at] == own)[:, None], self.ranks[at], PROFILE)
        place = np.arange(len(own))[:, None]
        out = np.where(ranks == PROFILE, PROFILE, np.abs(ranks - place)).sum(axis=0)
        best = int(out.argmin())
        return self.names[best], float(1 - out[best] / (PROFILE * len(own)))


def fit(documents: DataFrame, sample_docs: int = 600) -> LanguageModel:
    """Learn from (text, lang, doc_id); the caller leaves out what must not be learned."""
    labelled = documents.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    chosen = sample_per_class(labelled.select("doc_id", "lang"), "lang", "doc_id", sample_docs, "language")
    # At most sample_docs ids of each language are broadcast.
    sample = labelled.select("doc_id", "lang", "text").join(F.broadcast(chosen.distinct()), ["doc_id", "lang"])

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for lang, text in zip(part["lang"], part["text"]):
                grams, counts = ranked_grams(text, 1 << 30)
                rows.append(pd.DataFrame({"lang": lang, "gram": grams.astype(np.int64), "n": counts}))
            if rows:
                yield pd.concat(rows).groupby(["lang", "gram"], as_index=False)["n"].sum()

    counted = sample.select("lang", "text").mapInPandas(count, "lang string, gram long, n long")
    counted = Scratch(documents.sparkSession).stage(
        counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language-grams"
    )
    profiles = {}
    for name in sorted(r["lang"] for r in counted.select("lang").distinct().collect()):
        best = counted.filter(F.col("lang") == name).orderBy(F.desc("n"), "gram").limit(PROFILE)
        profiles[name] = [r["gram"] for r in best.collect()]
    grams = np.array(sorted({g for p in profiles.values() for g in p}), np.uint64)
    ranks = np.full((len(grams), len(profiles)), PROFILE, np.int64)
    for j, profile in enumerate(profiles.values()):
        ranks[np.searchsorted(grams, np.array(profile, np.uint64)), j] = np.arange(len(profile))
    return LanguageModel(list(profiles), grams, ranks)


def with_language(documents: DataFrame, model: LanguageModel, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``documents`` with the predicted language and its score."""

    @F.pandas_udf("lang string, score double")
    def judge(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame([model.judge(text) for text in part], columns=["lang", "score"])

    judged = fresh(documents, "_judged")
    out = documents.withColumn(judged, judge(F.col("text")))
    return out.withColumn(lang, F.col(judged)["lang"]).withColumn(score, F.col(judged)["score"]).drop(judged)
