"""Where documents hold passages of a benchmark: multi-pattern search over words.

The patterns are all windows of ``WINDOW`` consecutive words of an item (a shorter item is one
pattern). They are searched as Wu and Manber do, with words for letters: a table over blocks of
two words says how far the search may jump because no pattern can end before; where it may not
jump, a bucket chosen by the block at the end, and in it by the block at the start, lists the
patterns, and comparing words confirms them. Items shorter than a window are searched apart, by
length, so that they don't shorten the jumps of the others.

Documents are read once, as a map over partitions without a shuffle. The patterns are broadcast
in parts of at most ``PART_WORDS`` words; a task holds the tables of one part at a time, so a benchmark of
any size can be searched.

Defined cases: null texts have no words. Items without words are never found. Items that share an
id count as one; a null id is left out of the count and the list, while its passages are still
found. Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. Repeated
rows are judged each; further columns stay.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import fresh

WINDOW = 10
PART_WORDS = 200_000
#: Digits, lower-case letters and every byte of a character beyond ASCII are kept, A-Z lower-cased.
_TABLE = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(_TABLE).split()


class WuManber:
    """Search for patterns (tuples of words) of at least ``m`` words, m the shortest's length."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list[int]]):
        self.m = m = min(map(len, patterns))
        self.block = block = min(2, m)
        self.jump = m - block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list]] = {}
        for words, items in patterns.items():
            for end in range(block, m + 1):
                key = words[end - block : end]
                self.shift[key] = min(self.shift.get(key, self.jump), m - end)
            bucket = self.buckets.setdefault(words[m - block : m], {})
            bucket.setdefault(words[:block], []).append((list(words), items))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, int, list[int]]]:
        """(start, end, items) of every occurrence."""
        m, block, jump, shift = self.m, self.block, self.jump, self.shift.get
        end, n = m, len(words)
        while end <= n:
            last = (words[end - 2], words[end - 1]) if block == 2 else (words[end - 1],)
            step = shift(last, jump)
            if step:
                end += step
                continue
            start = end - m
            for pattern, items in self.buckets[last].get(tuple(words[start : start + block]), ()):
                if words[start : start + len(pattern)] == pattern:
                    yield start, start + len(pattern), items
            end += 1


def searchers(items: list[list[bytes]], window: int = WINDOW) -> list[WuManber]:
    """Searches for all windows of the items, given as words."""
    by_length: dict[int, dict[tuple[bytes, ...], list[int]]] = {}
    for i, words in enumerate(items):
        size = min(window, len(words))
        for start in range(len(words) - size + 1 if size else 0):
            found = by_length.setdefault(size, {}).setdefault(tuple(words[start : start + size]), [])
            if not found or found[-1] != i:
                found.append(i)
    return [WuManber(patterns) for patterns in by_length.values()]


_current: tuple[object, list[WuManber], list[str | None]] | None = None


def _tables(part) -> tuple[list[WuManber], list[str | None]]:
    """The tables of one broadcast part; those of the part before are let go."""
    global _current
    if _current is None or _current[0] != part.id:
        names, items, window = pickle.loads(part.value)
        _current = None
        _current = (part.id, searchers(items, window), names)
    return _current[1:]


class _Part:
    """A broadcast part, told from others by ``id`` on the executors."""

    def __init__(self, spark, number: int, payload: bytes):
        self._broadcast = spark.sparkContext.broadcast(payload)
        self.id = (self._broadcast._jbroadcast.id(), number)

    def __getstate__(self):
        return {"_broadcast": self._broadcast, "id": self.id}

    @property
    def value(self) -> bytes:
        return self._broadcast.value


def _parts(benchmark: DataFrame, window: int) -> list[_Part]:
    """The benchmark's items in parts; rows come to the driver one partition at a time."""
    spark = benchmark.sparkSession
    parts, names, items, size = [], [], [], 0

    def close() -> None:
        nonlocal names, items, size
        if items:
            parts.append(_Part(spark, len(parts), pickle.dumps((names, items, window))))
        names, items, size = [], [], 0

    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("binary").alias("text"))
    for name, raw in rows.toLocalIterator():
        words = words_of(bytes(raw) if raw is not None else None)
        # A very long item is cut with an overlap, so that every window is in one part.
        for start in range(0, max(1, len(words) - window + 1), PART_WORDS):
            piece = words[start : start + PART_WORDS + window - 1]
            if piece:
                names.append(name)
                items.append(piece)
                size += len(piece)
                if size >= PART_WORDS:
                    close()
    close()
    return parts


def _search(text: Column, part: _Part) -> Column:
    """(n_words, spans of hit words, ids of the items found) of each whole text."""

    @F.pandas_udf("n_words long, spans array<struct<start:long,end:long>>, items array<string>")
    def search(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            tables, names = _tables(part)
            rows = []
            for raw in batch:
                words = words_of(raw)
                found, items = [], set()
                for table in tables:
                    for start, end, of in table.search(words):
                        found.append((start, end))
                        items.update(of)
                spans: list[list[int]] = []
                for start, end in sorted(found):
                    if spans and start <= spans[-1][1]:
                        spans[-1][1] = max(end, spans[-1][1])
                    else:
                        spans.append([start, end])
                ids = sorted({names[i] for i in items if names[i] is not None})
                rows.append((len(words), [{"start": s, "end": e} for s, e in spans], ids))
            yield pd.DataFrame(rows, columns=["n_words", "spans", "items"])

    return search(text.cast("binary"))


def with_matches(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``documents`` with n_words, n_hit, items (sorted ids) and contaminated."""
    parts = _parts(benchmark, window) or [_Part(documents.sparkSession, 0, pickle.dumps(([], [], window)))]
    out, names = documents, []
    for part in parts:
        names.append(fresh(out, "_found"))
        out = out.withColumn(names[-1], _search(F.col("text"), part))
    spans = F.array_sort(F.flatten(F.array(*[F.col(n)["spans"] for n in names])))
    items = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(n)["items"] for n in names]))))
    zero = F.lit(0).cast("long")

    def count(so_far: Column, span: Column) -> Column:
        fresh_words = span["end"] - F.greatest(so_far["end"], span["start"])
        return F.struct(
            F.greatest(so_far["end"], span["end"]).alias("end"),
            (so_far["hit"] + F.greatest(zero, fresh_words)).alias("hit"),
        )

    start = F.struct(zero.alias("end"), zero.alias("hit"))
    return (
        out.withColumn("n_words", F.col(names[0])["n_words"])
        .withColumn("n_hit", F.aggregate(spans, start, count, lambda x: x["hit"]))
        .withColumn("items", items)
        .withColumn("contaminated", F.col("n_hit") > 0)
        .drop(*names)
    )
