"""Documents whose sets of word n-grams are alike: an exact Jaccard join, as components.

Sets and order. A document's set holds the hashes of its distinct n-word shingles. All sets are
ordered by one order, rare shingles first: a table of bounded size, which grows with the texts, counts the shingles of all
documents by a part of the hash, and the order is (count's level, hash). The table only
makes the order good; any order gives right results.

Copies. Documents with the same set are one class (128-bit digest), represented by the smallest id.

Candidates. Two sets with a similarity of t share one of their first |x| - ceil(t |x|) + 1 elements
(prefix filter). So the prefixes are the posting lists' rows, and pairs meet on an element. A pair
goes on if its sizes allow t (length filter), and if what lies before and behind the
shared element in both lists is enough (positional filter), and if the counts of the elements by
hash class, whose smaller ones bound the overlap, are enough (suffix filter; where lists are compared
with themselves, a pair meets on the first element that both prefixes have only, and the counts'
parities are compared within the join already: every class of different parity holds an element that only one set has). Each pair is
then verified once, on whole sets made again from the texts.

Large groups. Comparing all members of a list with each other would take the square of its
length. First every list's members are compared with its first document only. What is then linked is
one component, and within a component no further pair is needed. Lists that still
hold several components are compared between components, the largest component's
members against the others only. So no link between components is missed, and no group is
compared within itself.

Defined cases: null and empty texts, and texts without words, have an empty set and are linked
with nothing. Fewer words than n are one shingle. Rows that share an id are one document: it is linked if one
of its texts is. Rows without an id are one document too, which comes last; its component is null
unless it is linked to one with an id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.bloom import contains, filter_bits, seen_twice
from cartwright.llm.components import components
from cartwright.sources.scratch import Scratch

#: Of the table of counts: about a cell a word, within these bounds.
LEAST_CELLS, MOST_CELLS = 1 << 18, 1 << 23
CLASSES = 128  # of the suffix filter
PARITIES = 512
NO_ID = (1 << 63) - 1
_MOST = (1 << 16) - 1
_STRETCHES = 256  # that the table of counts is cut into on its way
_CACHED = 150_000


class _Words(dict):
    """64-bit numbers of words; let go when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _CACHED:
            self.clear()
        number = self[word] = xxhash.xxh3_64_intdigest(word)
        return number


_words = _Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _factors(n: int) -> np.ndarray:
    return _mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(raw: bytes | None, n: int) -> np.ndarray:
    """The distinct hashes of a text's n-word shingles, sorted."""
    words = (raw or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    size = min(n, len(ids))
    factors = _factors(size)
    count = len(ids) - size + 1
    total = np.full(count, size if size < n else 0, np.uint64)
    for j in range(size):
        total += ids[j : j + count] * factors[j]
    return np.unique(_mixed(total))


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that few texts are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _cell(hashes: np.ndarray, cells: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - cells.bit_length() + 1)).astype(np.int64)


def _levels(texts: DataFrame, n: int) -> bytes:
    """For each cell of the table of counts a level, eight to an octave: ``MOST_CELLS`` bytes at most."""
    schema = "stretch int, counts binary"
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = min(MOST_CELLS, max(LEAST_CELLS, 1 << (size // 6).bit_length()))
    stretch = cells // _STRETCHES

    def batch_of(counts: np.ndarray, k: int) -> pa.RecordBatch:
        packed = zstandard.compress(counts.tobytes(), 1)
        return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([packed])], ["stretch", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(cells, np.uint16)
        for batch in _slices(batches):
            for raw in batch.column(0).to_pylist():
                found, times = np.unique(_cell(shingles(raw, n), cells), return_counts=True)
                # A task's counts stop at what fits; such a cell is among the last of the order anyway.
                counts[found] = np.minimum(counts[found].astype(np.uint32) + times, _MOST).astype(np.uint16)
        for k, part in enumerate(counts.reshape(-1, stretch)):
            if part.any():
                yield batch_of(part, k)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(zstandard.decompress(raw), np.uint16)
                kept[k] = kept[k] + part if k in kept else part.astype(np.uint64)
        for k, total in kept.items():
            yield batch_of(np.minimum(255, np.log2(total + 1.0) * 8).astype(np.uint8), k)

    partitions = texts.sparkSession.sparkContext.defaultParallelism
    merged = texts.select("text").mapInArrow(count, schema).repartition(partitions, "stretch").mapInArrow(merge, schema)
    levels = np.zeros(cells, np.uint8)
    for row in merged.collect():
        at = row["stretch"] * stretch
        levels[at : at + stretch] = np.frombuffer(zstandard.decompress(bytes(row["counts"])), np.uint8)
    return levels.tobytes()


def _features(texts: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(doc, n, d1, d2: digest, prefix: first elements in the rare-first order, classes: counts,
    parities: bits).
    """
    levels = texts.sparkSession.sparkContext.broadcast(_levels(texts, n))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level_of = np.frombuffer(levels.value, np.uint8)
        for batch in _slices(batches):
            rows = []
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = shingles(raw, n)
                size = len(own)
                digest = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), np.int64)
                first = size - -(-num * size // den) + 1 if size else 0
                order = np.lexsort((own, level_of[_cell(own, len(level_of))]))[:first]
                counts = np.bincount((own & np.uint64(CLASSES - 1)).astype(np.int64), minlength=CLASSES)
                classes = counts.astype(np.uint16).tobytes() if counts.max(initial=0) < 1 << 16 else b""
                odd = np.bincount((own >> np.uint64(7) & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1
                parities = np.packbits(odd.astype(np.uint8)).view(np.int64)
                rows.append((doc, size, digest[0], digest[1], own[order].view(np.int64), classes, parities))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                [name for name, _ in columns],
            )

    longs = pa.list_(pa.int64())
    columns = [(c, pa.int64()) for c in ("doc", "n", "d1", "d2")]
    columns += [("prefix", longs), ("classes", pa.binary()), ("parities", longs)]
    types = [t for _, t in columns]
    return texts.mapInArrow(
        describe, "doc long, n long, d1 long, d2 long, prefix array<long>, classes binary, parities array<long>"
    )


def _may_be_alike(a: str, b: str, num: int, den: int) -> Column:
    """Length and positional filter of two rows (n, rest: elements behind the shared one)."""
    na, nb, ra, rb = (F.col(f"{x}.{c}") for c in ("n", "rest") for x in (a, b))
    # overlap * (num + den) >= num * (na + nb)
    most = F.least(na - ra, nb - rb) + F.least(ra, rb)
    return (na * den >= nb * num) & (nb * den >= na * num) & (most * (num + den) >= (na + nb) * num)


def _first_shared_allows(a: str, b: str, num: int, den: int) -> Column:
    """Length and positional filter of two rows on the first element that both sets have."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    most = 1 + F.least(F.col(f"{a}.rest"), F.col(f"{b}.rest"))
    return (na * den >= nb * num) & (nb * den >= na * num) & (most * (num + den) >= (na + nb) * num)


def _parities_allow(a: str, b: str, num: int, den: int) -> Column:
    """At least one element that only one set has for each class of different parity."""
    n = F.col(f"{a}.n") + F.col(f"{b}.n")
    apart = [
        F.bit_count(F.col(f"{a}.parities")[i].bitwiseXOR(F.col(f"{b}.parities")[i])) for i in range(PARITIES // 64)
    ]
    return (n - sum(apart[1:], apart[0])) * (num + den) >= n * (2 * num)


def _overlap(with_sets: bool) -> Column:
    """What two sets share: of their classes (an upper bound; null if unknown), or of the sets."""

    @F.pandas_udf("long")
    def shared(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            if with_sets:
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                out.append(len(np.intersect1d(x, y, assume_unique=True)))
            elif x and y:
                both = np.minimum(np.frombuffer(x, np.uint16), np.frombuffer(y, np.uint16))
                out.append(int(both.sum(dtype=np.int64)))
            else:
                out.append(1 << 40)
        return pd.Series(out, dtype="int64")

    return shared("a_set", "b_set")


def _verified(
    pairs: DataFrame, features: DataFrame, texts: DataFrame, n: int, num: int, den: int, scratch: Scratch
) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b) that are alike."""

    def beside(rows: DataFrame, side: str, sets: DataFrame) -> DataFrame:
        named = sets.select(
            F.col("doc").alias(side), F.col("n").alias(f"{side}_n"), F.col("set").alias(f"{side}_set")
        )
        return rows.join(named, side)

    enough = F.col("shared") * (num + den) >= (F.col("a_n") + F.col("b_n")) * num
    classes = features.select("doc", "n", F.col("classes").alias("set"))
    near = beside(beside(pairs, "a", classes), "b", classes).withColumn("shared", _overlap(False)).filter(enough)
    near = scratch.stage(near.select("a", "b").distinct(), "candidates")
    involved = near.select(F.col("a").alias("doc")).union(near.select("b"))
    bits = filter_bits(2 * near.count())

    def hashes(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)

    hashed = involved.select(F.xxhash64("doc").alias("h"))
    # Says which texts are needed; a few more may pass, and drop out in the join.
    needed = texts.sparkSession.sparkContext.broadcast(seen_twice(hashed, hashes, bits, once=True))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            wanted = contains(needed.value, hashes(batch.select([2])))
            batch = batch.filter(pa.array(wanted))
            sets = [shingles(raw, n) for raw in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, sets), pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                ["doc", "n", "set"],
            )

    sets = texts.select("doc", "text", F.xxhash64("doc").alias("h")).mapInArrow(make, "doc long, n long, set binary")
    sets = scratch.stage(sets, "sets")
    alike = beside(beside(near, "a", sets), "b", sets).withColumn("shared", _overlap(True)).filter(enough)
    links = scratch.stage(alike.select("a", "b").distinct(), "links")
    scratch.drop(sets, near)
    return links


def _same_id(features: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (class, id) of ids that have several different texts."""
    of = features.filter("n > 0").groupBy("doc").agg(F.min("d1").alias("low"), F.max("d1").alias("high"))
    several = scratch.stage(of.filter("low <> high").select("doc"), "ids-with-several-texts")
    rows = features.select("doc", "d1", "d2").join(several, "doc").join(classes, ["d1", "d2"])
    return rows.select(F.col("node").alias("a"), F.col("doc").alias("b"))


def similar_documents(documents: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row; alike means a similarity of num / den or more."""
    scratch = Scratch(documents.sparkSession)
    texts = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.col("text").cast("binary").alias("text")
    )
    described = scratch.stage(_features(texts, n, num, den), "described")
    # One narrow row a document; of the rest one a class is kept.
    features = scratch.stage(described.select("doc", "n", "d1", "d2"), "features")
    classes = features.filter("n > 0").groupBy("d1", "d2").agg(F.min("doc").alias("node"))
    classes = scratch.stage(classes, "classes")
    first = described.join(classes.withColumnRenamed("node", "doc"), ["d1", "d2", "doc"], "left_semi")
    first = scratch.stage(
        first.dropDuplicates(["d1", "d2", "doc"]).select("doc", "n", "prefix", "classes", "parities"),
        "representatives",
    )
    scratch.drop(described)
    postings = first.select("doc", "n", F.posexplode("prefix").alias("place", "token")).select(
        "token", "doc", "n", (F.col("n") - F.col("place") - 1).alias("rest")
    )

    # Round 1: each list's members against its first document.
    size_and_rest = F.col("n") * F.lit(1 << 31) + F.col("rest")
    lists = postings.groupBy("token").agg(
        F.min("doc").alias("hub"),
        F.max("doc").alias("last"),
        F.min_by(size_and_rest, "doc").alias("hub_at"),
        F.count("*").alias("members"),
    )
    lists = scratch.stage(lists.filter("hub < last").drop("last"), "lists")
    shared = scratch.stage(postings.join(lists, "token"), "shared-postings")
    scratch.drop(lists)
    hub = F.struct(F.shiftright("hub_at", 31).alias("n"), F.col("hub_at").bitwiseAND((1 << 31) - 1).alias("rest"))
    by_hub = shared.withColumn("h", hub).withColumn("m", F.struct("n", "rest"))
    pairs = by_hub.filter((F.col("hub") < F.col("doc")) & _may_be_alike("h", "m", num, den))
    pairs = pairs.select(F.col("hub").alias("a"), F.col("doc").alias("b")).distinct()
    links = _verified(pairs, first, texts, n, num, den, scratch).union(_same_id(features, classes, scratch))
    known = scratch.stage(components(links, scratch), "components")

    # Round 2: lists that hold several components, between components.
    labelled = shared.filter("members > 2").join(known.withColumnRenamed("node", "doc"), "doc", "left")
    labelled = scratch.stage(
        labelled.withColumn("component", F.coalesce("component", "doc")).drop("hub_at", "members"), "labelled"
    )
    scratch.drop(shared)
    parts = labelled.groupBy("token", "component").agg(F.count("*").alias("members"))
    mixed = parts.groupBy("token").agg(
        F.max_by("component", F.col("members")).alias("largest"), F.count("*").alias("parts")
    )
    mixed = scratch.stage(mixed.filter("parts > 1").drop("parts"), "mixed-lists")
    rest = labelled.join(mixed, "token").join(first.select("doc", "n", "prefix", "parities"), ["doc", "n"])
    place = (F.col("n") - F.col("rest") - 1).cast("int")
    rest = rest.filter(F.get("prefix", place) == F.col("token")).withColumn("before", F.slice("prefix", F.lit(1), place))
    rest = scratch.stage(rest.drop("prefix"), "mixed-postings")
    scratch.drop(labelled, mixed)
    one, other = rest.filter("component <> largest").alias("x"), rest.alias("y")
    apart = (
        (F.col("x.token") == F.col("y.token"))
        & (F.col("x.component") != F.col("y.component"))
        & (F.col("x.doc") != F.col("x.hub"))
        & (F.col("y.doc") != F.col("y.hub"))
    )
    # A pair meets on the first element that both prefixes have, and on no other.
    first_shared = ~F.arrays_overlap("x.before", "y.before")
    more = one.join(
        other, apart & _first_shared_allows("x", "y", num, den) & _parities_allow("x", "y", num, den) & first_shared
    ).select(
        F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b")
    )
    further = _verified(more.distinct(), first, texts, n, num, den, scratch)
    if not further.isEmpty():
        known = scratch.stage(components(links.union(further), scratch), "components")

    by_class = scratch.stage(
        classes.join(known, "node", "left").select("d1", "d2", F.coalesce("component", "node").alias("class")), "by-class"
    )
    out = features.select("doc", "n", "d1", "d2").join(by_class, ["d1", "d2"], "left")
    real = lambda c: F.when(c != NO_ID, c)
    return out.select(
        real(F.col("doc")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        real(F.coalesce("class", "doc")).alias("component_id"),
    )
