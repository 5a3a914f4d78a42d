"""Quality by compression: which dictionary shortens a text more, the good or the bad one?

A text is cut into blocks. Each block is compressed twice, with a zstandard dictionary built
from good labelled text and with one built from bad labelled text. The difference of the two
total sizes, divided by the text's size, is the text's only feature; a logistic curve fitted on
other labelled documents turns it into a probability. A short text says little, so ``PRIOR_BYTES``
bytes of the labelled documents' mean difference are added to every text.

The model is fitted on a bounded sample of labelled rows: at most ``sample_docs`` documents of
each label, half for the dictionaries (at most ``sample_blocks`` blocks of each label) and half
for the curve. Scoring is one pass over the whole texts without a shuffle.

Defined cases: labels that are null or not 0/1, or whose id no document has, are left out.
A null text counts as empty, and an empty one gets the curve's value at the mean difference. With no label,
or labels of one kind only, every score is the (smoothed) share of good labels. Repeated rows are
scored each; further columns stay.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import fresh, sample_per_class
from cartwright.sources.scratch import Scratch

BLOCK = 512
LEVEL = 3
PRIOR_BYTES = 100


@dataclass(frozen=True)
class QualityModel:
    good: bytes | None
    bad: bytes | None
    mean: float
    slope: float
    intercept: float


def _blocks(raw: bytes) -> list[bytes]:
    return [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(dictionary)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=known, level=LEVEL, write_content_size=False)


def difference(text: Column, good: bytes, bad: bytes) -> Column:
    """(gap, size) of each whole text: bytes that the bad dictionary needs more, and all bytes."""

    @F.pandas_udf("gap long, size long")
    def measure(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        by_good, by_bad = _compressor(good), _compressor(bad)
        for part in parts:
            rows = []
            for raw in part:
                raw = raw or b""
                gap = sum(len(by_bad.compress(b)) - len(by_good.compress(b)) for b in _blocks(raw))
                rows.append((gap, len(raw)))
            yield pd.DataFrame(rows, columns=["gap", "size"])

    return measure(text.cast("binary"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, labels = (batch.column(i).to_pylist() for i in range(2))
        rows = [(b, q) for raw, q in zip(texts, labels) for b in _blocks(raw or b"")]
        columns = [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["block", "label"])


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression of one feature, with a slight pull of the slope to zero."""
    spread = float(x.std()) or 1.0
    z, a, b = x / spread, 0.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        g, h = weight * (p - y), weight * p * (1 - p)
        gradient = np.array([(g * z).sum() + 1e-2 * a, g.sum() + 1e-6 * b])
        curve = np.array([[(h * z * z).sum() + 1e-2, (h * z).sum()], [(h * z).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(curve, gradient)
        step *= min(1.0, 4.0 / max(1e-12, float(np.abs(step).max())))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return a / spread, b


def fit(
    documents: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    sample_docs: int = 4000,
    sample_blocks: int = 8000,
    dictionary_bytes: int = 16 * 1024,
) -> QualityModel:
    """Fit on ``labels`` (doc_id, ``label``); the caller leaves out what must not be learned."""
    spark = documents.sparkSession
    known = labels.select("doc_id", F.col(label).cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).distinct()
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    prior = (totals.get(1, 0) + 0.5) / (sum(totals.values()) + 1)
    flat = QualityModel(None, None, 0.0, 0.0, math.log(prior / (1 - prior)))
    if len(totals) < 2:
        return flat
    chosen = sample_per_class(known, "label", "doc_id", sample_docs, "quality")
    texts = documents.select("doc_id", F.col("text").cast("binary").alias("text"))
    # At most 2 * sample_docs ids are broadcast.
    sample = texts.join(F.broadcast(chosen), "doc_id").withColumn(
        "for_curve", F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)) == 1
    )
    sample = Scratch(spark).stage(sample, "quality-sample")
    cut = sample.filter(~F.col("for_curve")).select("text", "label").mapInArrow(_cut, "block binary, label int")
    blocks = {0: [], 1: []}
    for row in sample_per_class(cut.distinct(), "label", "block", sample_blocks, "block").collect():
        blocks[row["label"]].append(bytes(row["block"]))
    if min(map(len, blocks.values())) < 8:
        return flat
    good, bad = (
        zstandard.train_dictionary(
            min(dictionary_bytes, max(1024, sum(map(len, blocks[q])) // 4)), sorted(blocks[q]), level=LEVEL
        ).as_bytes()
        for q in (1, 0)
    )
    measured = difference(F.col("text"), good, bad)
    curve = sample.filter("for_curve").select(measured.alias("m"), "label").select("m.*", "label").collect()
    gap, size, y = (np.array([float(r[c]) for r in curve]) for c in ("gap", "size", "label"))
    if len(set(y)) < 2:
        return flat
    # The sample holds both labels alike; the weights give each its share of all labels.
    share = {q: totals[int(q)] / (y == q).sum() for q in (0.0, 1.0)}
    weight = np.array([share[q] for q in y]) * len(y) / sum(totals.values())
    mean = float((weight * gap).sum() / max(1.0, (weight * size).sum()))
    x = (gap + PRIOR_BYTES * mean) / (size + PRIOR_BYTES)
    return QualityModel(good, bad, mean, *map(float, _logistic(x, y, weight)))


def with_score(documents: DataFrame, model: QualityModel, name: str = "score") -> DataFrame:
    """``documents`` with the probability of a good label."""
    if model.good is None:
        return documents.withColumn(name, F.lit(1 / (1 + math.exp(-model.intercept))))
    gap = fresh(documents, "_gap")
    measured = documents.withColumn(gap, difference(F.col("text"), model.good, model.bad))
    x = (F.col(gap)["gap"] + F.lit(PRIOR_BYTES * model.mean)) / (F.col(gap)["size"] + PRIOR_BYTES)
    odds = F.lit(model.slope) * x + F.lit(model.intercept)
    return measured.withColumn(name, 1 / (1 + F.exp(-odds))).drop(gap)
