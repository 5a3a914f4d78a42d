"""Documents packed into sequences of tokens, by bin completion.

1. Tokenize: each task cuts its documents into pieces of at most ``capacity`` tokens and keeps place, length
   and checksum of each (one written narrow table).
2. Count the pieces of each length: at most ``capacity`` rows, whatever the input, are what the driver
   sees. Bin completion (``bin_completion``) turns them into patterns and numbers of sequences.
3. Number the pieces of each length from 0. A length of very many pieces is dealt out by a salt; each part is
   numbered in a task of its own and starts where the parts before it end.
4. Length and number say which pattern, which sequence and which offset a piece has: the patterns
   are at most some hundred thousand rows (a pattern has fewer than sqrt(2 * capacity) different lengths), which are broadcast.

Defined cases: null texts are empty; an empty text is the end id alone. Only documents of more than ``capacity``
tokens are cut. Repeated rows and rows without an id are packed each. Which of several pieces of
one length goes where is open; how many sequences there are is not. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.llm.bin_completion import STEPS, Pattern, bin_completion
from cartwright.llm.common import shuffle_partitions
from cartwright.llm.subwords import Encoder, bpe_encoder, folded_words, stretches
from cartwright.sources.scratch import Scratch

CAPACITY = 4096
END = 1
BATCH_BYTES = 4_000_000
_PIECES = "tag long, piece int, start long, length long, ids_crc32 long"

_encoder: tuple[str, Encoder] | None = None


def _loaded(spec: str) -> Encoder:
    """The tokenizer, once a worker."""
    global _encoder
    key = hashlib.sha256(spec.encode()).hexdigest()
    if _encoder is None or _encoder[0] != key:
        _encoder = key, bpe_encoder(spec, folded_words, specials_are_text=False)
    return _encoder[1]


def token_pieces(
    documents: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False
) -> DataFrame:
    """doc_id, an own number for each piece, piece, start, length, ids_crc32 (and the ids).

    ``path`` names a tokenizer file that drops white space and case; its size does not depend on any input.
    """
    with open(path, encoding="utf-8") as file:
        spec = documents.sparkSession.sparkContext.broadcast(file.read())
    last = np.array([end], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _loaded(spec.value)
        tag = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = batch.column(1)
            for begin, stop in stretches(pc.binary_length(texts).to_pylist(), BATCH_BYTES):
                of, pieces, starts, lengths, sums, ids = [], [], [], [], [], []
                for i, raw in enumerate(encoder.encode([t or "" for t in texts[begin:stop].to_pylist()])):
                    raw += last
                    for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                        part = raw[at : at + 4 * capacity]
                        of.append(i)
                        pieces.append(k)
                        starts.append(at // 4)
                        lengths.append(len(part) // 4)
                        sums.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(np.frombuffer(part, "<u4").astype(np.int32))
                columns = [
                    batch.column(0)[begin:stop].take(pa.array(of, pa.int64())),
                    pa.array(tag + np.arange(len(of))),
                    pa.array(pieces, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (starts, lengths, sums)),
                    *([pa.array(ids, pa.list_(pa.int32()))] if with_ids else []),
                ]
                tag += len(of)
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "tag", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {_PIECES}" + ", ids array<int>" * with_ids
    return documents.select("doc_id", "text").mapInArrow(cut, schema)


class Places:
    """Where the n-th piece of a length goes."""

    SHIFT = 48

    def __init__(self, patterns: list[tuple[Pattern, int]]):
        rows, taken, sequence = [], {}, 0
        for pattern, bins in patterns:
            offset = 0
            for size, each in pattern:
                first = taken.get(size, 0)
                rows.append((size << self.SHIFT | first, first, sequence, each, offset, size))
                taken[size] = first + bins * each
                offset += size * each
            sequence += bins
        table = np.array(sorted(rows), np.int64).reshape(-1, 6)
        self.key, self.first, self.sequence, self.each, self.offset, self.size = table.T

    def of(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset)"""
        at = np.searchsorted(self.key, length << self.SHIFT | number, side="right") - 1
        place = number - self.first[at]
        return self.sequence[at] + place // self.each[at], self.offset[at] + place % self.each[at] * self.size[at]


def numbered(pieces: DataFrame, by: str, order: str, name: str) -> DataFrame:
    """Rows of written ``pieces`` with their number within ``by``, from 0, without a task for a whole ``by``."""
    salts = shuffle_partitions(pieces.sparkSession)
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(order), F.lit(salts)))
    own = F.row_number().over(Window.partitionBy(by, "_salt").orderBy(order)) - 1
    sizes = salted.groupBy(by, "_salt").agg(F.count("*").alias("_n"))
    so_far = Window.partitionBy(by).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(by, "_salt", F.coalesce(F.sum("_n").over(so_far), F.lit(0)).alias("_before"))
    rows = salted.withColumn("_own", own).join(before, [by, "_salt"])
    return rows.withColumn(name, F.col("_own") + F.col("_before")).drop("_salt", "_own", "_before")


def pack(
    documents: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end: int = END,
    steps: int = STEPS,
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and the ids) of each piece."""
    spark = documents.sparkSession
    pieces = Scratch(spark).stage(token_pieces(documents, path, capacity, end, with_ids), "pieces")
    # At most ``capacity`` rows.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = spark.sparkContext.broadcast(Places(bin_completion(counts, capacity, steps)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            sequence, offset = places.value.of(length, number)
            kept = [c for c in batch.schema.names if c not in ("tag", "number")]
            columns = [batch.column(c) for c in kept] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "sequence_id", "offset"])

    ready = numbered(pieces, "length", "tag", "number")
    shape = [f for f in ready.schema.fields if f.name not in ("tag", "number")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in shape) + ", sequence_id long, offset long"
    return ready.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, starts): the sequences themselves, from ``pack`` with ids.

    A sequence has at most ``capacity`` tokens, so no group is large.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id")))
    grouped = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return grouped.select(
        "sequence_id",
        F.flatten("parts.ids").alias("ids"),
        F.col("parts.doc_id").alias("doc_ids"),
        F.col("parts.offset").alias("starts"),
    )
