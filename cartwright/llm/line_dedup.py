"""Lines that several documents hold stay in one of them only.

1. Count the lines, which fixes the size of the filters (bounded, see ``bloom``).
2. Fill two Bloom filters over the hashes of all lines' keys: seen once and seen twice.
3. Only lines that the second filter suspects leave their task, as a 128-bit digest with the id
   of their document. Grouping them confirms which digests two documents really hold, and which document is first.
4. The confirmed lines, except those of the first document, go to their documents.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased. Keys of fewer
than ``least`` code points are never dropped.

Defined cases: a null or empty text is one empty line. Rows that share an id are one document, and
rows without an id are one document that comes after all others. Repeats of a line within its
first document stay. Further columns stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.bloom import contains, filter_bits, seen_twice
from cartwright.llm.common import fresh
from cartwright.sources.scratch import Scratch

LEAST = 10


def line_keys(raw: bytes | None, least: int = LEAST) -> list[bytes | None]:
    """The key of each line, or None where it is too short."""
    keys: list[bytes | None] = []
    for line in (raw or b"").lower().split(b"\n"):
        key = line.strip(b" \t\n\r\x0b\x0c")
        long_enough = len(key) >= least and (
            len(key) >= 4 * least or key.isascii() or len(key.decode("utf-8", "replace")) >= least
        )
        keys.append(key if long_enough else None)
    return keys


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def repeated_lines(documents: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, lines): the digests of the lines each document has to give up."""
    spark = documents.sparkSession
    scratch = Scratch(spark)
    texts = documents.select("doc_id", F.col("text").cast("binary").alias("text"))
    breaks = F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    lines = documents.agg(F.sum(F.coalesce(breaks, F.lit(0)) + 1)).first()[0] or 0

    def hashes(batch: pa.RecordBatch) -> np.ndarray:
        found: list[int] = []
        for raw in batch.column(0).to_pylist():
            found.extend({xxhash.xxh3_64_intdigest(k) for k in line_keys(raw, least) if k})
        return np.array(found, np.uint64)

    twice = spark.sparkContext.broadcast(seen_twice(texts.select("text"), hashes, filter_bits(lines)))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests = [], []
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys = list({k for k in line_keys(raw, least) if k})
                if keys:
                    own = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
                    for j in np.flatnonzero(contains(twice.value, own)):
                        ids.append(i)
                        digests.append(_digest(keys[j]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema.field(0).type), pa.array(digests, pa.binary())], ["doc_id", "line"]
            )

    schema = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, line binary"
    suspected = scratch.stage(texts.mapInArrow(suspects, schema), "suspected-lines")
    held = suspected.groupBy("line").agg(
        F.min("doc_id").alias("first"),
        F.max("doc_id").alias("last"),
        F.count_if(F.col("doc_id").isNull()).alias("without_id"),
    )
    several = (F.col("first") < F.col("last")) | (F.col("without_id") > 0) & F.col("first").isNotNull()
    # Written, so that both sides of the join below are shuffled and a line of very many
    # documents is split among tasks.
    confirmed = scratch.stage(held.filter(several).select("line", "first"), "confirmed-lines")
    lost = suspected.join(confirmed, "line").filter(~F.col("doc_id").eqNullSafe(F.col("first")))
    return lost.groupBy("doc_id").agg(F.collect_set("line").alias("lines"))


def dedup_lines(
    documents: DataFrame,
    text: str = "text",
    n_lines: str = "n_lines",
    n_dropped: str = "n_dropped",
    least: int = LEAST,
) -> DataFrame:
    """``documents`` with the kept lines as ``text`` and the two counts."""

    @F.pandas_udf("kept string, n_lines long, n_dropped long")
    def drop(texts: pd.Series, lost: pd.Series) -> pd.DataFrame:
        rows = []
        for raw, gone in zip(texts, lost):
            raw = raw or b""
            lines = raw.split(b"\n")
            kept = lines
            if gone is not None and len(gone):
                gone = set(map(bytes, gone))
                kept = [s for s, k in zip(lines, line_keys(raw, least)) if k is None or _digest(k) not in gone]
            rows.append((b"\n".join(kept).decode("utf-8", "replace"), len(lines), len(lines) - len(kept)))
        return pd.DataFrame(rows, columns=["kept", "n_lines", "n_dropped"])

    # A filter on its result would else be given a copy of it, and a task a second Python worker.
    drop = drop.asNondeterministic()
    key, lines, done = fresh(documents, "_of"), fresh(documents, "_lines"), fresh(documents, "_done")
    lost = repeated_lines(documents, least).select(F.col("doc_id").alias(key), F.col("lines").alias(lines))
    joined = documents.join(lost, F.col("doc_id").eqNullSafe(F.col(key)), "left").drop(key)
    out = joined.withColumn(done, drop(F.col("text").cast("binary"), F.col(lines)))
    for name, part in ((text, "kept"), (n_lines, "n_lines"), (n_dropped, "n_dropped")):
        out = out.withColumn(name, F.col(done)[part])
    return out.drop(done, lines)
