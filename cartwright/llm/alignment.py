"""Two tokenizers' tokens of the same text, aligned, and how often their ids meet.

A is a byte-level BPE file, B a sentence-piece file. Both spell the same bytes (a blank and the
text), so the places where a token of A and a token of B both end cut the tokens into groups,
and all tokens of A and B in a group are linked.

Lockstep merging. One vector of pointers into A's tokens and one into B's hold a lane each for
every document of a batch; a step moves the pointer whose token ends first, or both where
they end together, which closes a group. Lanes that have reached their end are dropped from the vectors. A
document of many tokens gets several lanes, which start where two tokens end together, so
that one long text does not run on alone.

Counts of linked ids. A document's distinct pairs are kept packed (sorted codes, differences,
compressed). Tasks add up the documents that hold a pair before anything is shuffled, and
one row a pair is left. Every link then looks up its pair: the ``HOT`` most frequent pairs
are broadcast (a fixed number of 17-byte rows), all others are joined by a shuffle, so the
table of pairs may have any size.

Defined cases: null and empty texts, and texts that one of the tokenizers does not give back byte by byte,
have no tokens, no groups and no links. Tokens' strings inside a text are plain text.
Repeated rows and rows without an id are documents of their own. A very long text is one group of lanes. An empty table
gives an empty result. Further columns stay in ``with_alignment``.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwright.llm.subwords import blank_and_word, bpe_encoder, byte_alphabet, piece_encoder, stretches
from cartwright.sources.scratch import Scratch

LANE = 256
PROBE = 32
BATCH_BYTES = 2_000_000
HOT = 1 << 19
#: A group of more links than this is counted by its distinct ids.
WIDE = 1 << 12


def piece_bytes(piece: str, is_byte: bool) -> bytes:
    """A piece's text: <0xHH> is a byte, U+2581 a blank."""
    return bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()


@dataclass
class Tokens:
    """Tokens of a batch's documents that both tokenizers spell, one after the other."""

    docs: np.ndarray  # places in the batch of those documents
    a: np.ndarray
    b: np.ndarray
    ends_a: np.ndarray  # byte offsets over all of them
    ends_b: np.ndarray
    first_a: np.ndarray  # each document's first token
    first_b: np.ndarray


class Pair:
    """Both tokenizers, from the contents of their files."""

    def __init__(self, spec_a: str, model_b: bytes):
        import sentencepiece

        self.encoder_a = bpe_encoder(spec_a, blank_and_word, specials_are_text=True)
        byte_of = byte_alphabet()
        vocabulary = json.loads(spec_a)["model"]["vocab"]
        self.size_a = max(vocabulary.values()) + 1
        self.bytes_a = [b""] * self.size_a
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(byte_of[c] for c in token if c in byte_of)
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        pieces = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        self.encoder_b = piece_encoder(pieces)
        self.size_b = pieces.get_piece_size()
        self.bytes_b = [piece_bytes(pieces.id_to_piece(i), pieces.is_byte(i)) for i in range(self.size_b)]
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)

    def tokens(self, texts: list[str | None]) -> Tokens:
        at = [i for i, t in enumerate(texts) if t]
        some = [f" {texts[i]}" for i in at]
        docs, a, b = [], [], []
        for i, text, x, y in zip(at, some, self.encoder_a.encode(some), self.encoder_b.encode(some)):
            x, y, raw = np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4"), text.encode()
            # A's tokens are cut from the text's bytes, so their length says whether all are there; B may rewrite a text.
            if self.length_a[x].sum() == len(raw) and b"".join(map(self.bytes_b.__getitem__, y.tolist())) == raw:
                docs.append(i)
                a.append(x)
                b.append(y)
        both = [np.concatenate(x) if x else np.zeros(0, np.uint32) for x in (a, b)]
        firsts = [np.cumsum([0, *map(len, x)])[:-1].astype(np.int64) for x in (a, b)]
        return Tokens(
            np.array(docs, np.int64),
            *both,
            np.cumsum(self.length_a[both[0]]),
            np.cumsum(self.length_b[both[1]]),
            *firsts,
        )


def lanes(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Where lanes start in A and B: at documents, and about every ``LANE`` tokens where both end."""
    starts = t.first_a
    ahead = np.arange(LANE, len(t.a), LANE)
    if len(ahead):
        probe = np.minimum(ahead[:, None] + np.arange(PROBE), len(t.a) - 1)
        ends = t.ends_a[probe]
        joint = t.ends_b[np.searchsorted(t.ends_b, ends)] == ends
        found = probe[np.arange(len(probe)), joint.argmax(axis=1)][joint.any(axis=1)] + 1
        starts = np.unique(np.concatenate([starts, found[found < len(t.a)]]))
    before = np.concatenate([[0], t.ends_a])[starts]
    return starts, np.searchsorted(t.ends_b, before, side="right")


def lockstep(t: Tokens) -> np.ndarray:
    """Groups as columns a_from, a_to, b_from, b_to, in the order of the text."""
    a, b = lanes(t)
    stop = np.append(a[1:], len(t.a))
    from_a, from_b = a, b
    closed = []
    while len(a):
        end_a, end_b = t.ends_a[a], t.ends_b[b]
        met = end_a == end_b
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
        if met.any():
            closed.append(np.stack([from_a[met], a[met], from_b[met], b[met]], axis=1))
            from_a, from_b = np.where(met, a, from_a), np.where(met, b, from_b)
            going = a < stop
            if not going.all():
                a, b, from_a, from_b, stop = (x[going] for x in (a, b, from_a, from_b, stop))
    groups = np.concatenate(closed) if closed else np.zeros((0, 4), np.int64)
    return groups[np.argsort(groups[:, 0])]


def linked_ids(t: Tokens, groups: np.ndarray, doc: np.ndarray, size_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, code of the ids, links) for each distinct pair of ids of a document, in order."""
    n_a, n_b = groups[:, 1] - groups[:, 0], groups[:, 3] - groups[:, 2]
    wide = n_a * n_b > WIDE
    plain, n = groups[~wide], (n_a * n_b)[~wide]
    of = np.repeat(np.arange(len(plain)), n)
    place = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    width = n_b[~wide][of]
    codes = t.a[plain[of, 0] + place // width].astype(np.int64) * size_b + t.b[plain[of, 2] + place % width]
    keys, times = np.unique(doc[~wide][of] << 40 | codes, return_counts=True)
    if wide.any():
        more_keys, more_times = [keys], [times]
        for (a, a_to, b, b_to), d in zip(groups[wide], doc[wide]):
            x, nx = np.unique(t.a[a:a_to].astype(np.int64), return_counts=True)
            y, ny = np.unique(t.b[b:b_to].astype(np.int64), return_counts=True)
            more_keys.append((d << 40 | x[:, None] * size_b + y).ravel())
            more_times.append((nx[:, None] * ny).ravel())
        keys, where = np.unique(np.concatenate(more_keys), return_inverse=True)
        times = np.bincount(where, np.concatenate(more_times)).astype(np.int64)
    return keys >> 40, keys & ((1 << 40) - 1), times


def _digits(size: int, signs: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Decimal numbers with each sign behind, as rows of bytes with zeros at the end, and their lengths."""
    words = [b"%d%c" % (i, s) for i in range(size) for s in signs]
    width = max(map(len, words))
    table = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
    return table, np.array(list(map(len, words)), np.int64)


class Spelling:
    """Groups as text: ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, size: int):
        self.table, self.length = _digits(size, b",|;")

    def digests(self, t: Tokens, groups: np.ndarray) -> list[str]:
        n = len(t.a) + len(t.b)
        codes = np.zeros(n, np.int64)
        place_a = np.arange(len(t.a)) + np.repeat(groups[:, 2], groups[:, 1] - groups[:, 0])
        place_b = np.arange(len(t.b)) + np.repeat(groups[:, 1], groups[:, 3] - groups[:, 2])
        sign_a, sign_b = np.zeros(len(t.a), np.int64), np.zeros(len(t.b), np.int64)
        sign_a[groups[:, 1] - 1], sign_b[groups[:, 3] - 1] = 1, 2
        codes[place_a], codes[place_b] = t.a * np.int64(3) + sign_a, t.b * np.int64(3) + sign_b
        text = self.table[codes].ravel()
        text = text[text != 0].tobytes()
        ends = np.append(0, np.cumsum(self.length[codes]))[np.append(t.first_a + t.first_b, n)]
        return [hashlib.sha256(text[i : j - 1]).hexdigest() for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]


def pack(codes: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted codes and how often each occurs, as compressed planes of bytes."""
    steps = np.diff(codes, prepend=0).astype("<u8").view(np.uint8).reshape(-1, 8)
    counts = times.astype("<u4").view(np.uint8).reshape(-1, 4)
    return zstandard.compress(np.concatenate([steps, counts], axis=1).T.tobytes(), 1)


def unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(12, -1)
    steps = np.ascontiguousarray(planes[:8].T).view("<u8").ravel()
    return np.cumsum(steps.astype(np.int64)), np.ascontiguousarray(planes[8:].T).view("<u4").ravel().astype(np.int64)


_pair: tuple[object, Pair, Spelling] | None = None


def _loaded(files: Broadcast) -> tuple[Pair, Spelling]:
    """The tokenizers, once a worker."""
    global _pair
    key = hashlib.sha256(files.value[1]).hexdigest(), hash(files.value[0])
    if _pair is None or _pair[0] != key:
        pair = Pair(*files.value)
        _pair = key, pair, Spelling(max(pair.size_a, pair.size_b))
    return _pair[1:]


def read_files(spark: SparkSession, path_a: str, path_b: str) -> Broadcast:
    """Both tokenizer files, whose sizes do not depend on any input."""
    with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:
        return spark.sparkContext.broadcast((a.read(), b.read()))


def with_alignment(documents: DataFrame, path_a: str, path_b: str, name: str = "alignment") -> DataFrame:
    """``documents`` with a struct of both tokenizers' ids and the numbers of tokens of each group.

    ``a_ids`` and ``b_ids`` hold the tokens, ``a_sizes`` and ``b_sizes`` how many of them each group takes.
    """
    files = read_files(documents.sparkSession, path_a, path_b)
    kind = "a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>"

    @F.pandas_udf(kind)
    def align(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        pair, _ = _loaded(files)
        for batch in batches:
            texts, rows = [t if isinstance(t, str) else None for t in batch], [([], [], [], [])] * len(batch)
            for start, stop in stretches([len(t or "") for t in texts], BATCH_BYTES):
                t = pair.tokens(texts[start:stop])
                groups = lockstep(t)
                first = np.append(t.first_a, len(t.a))
                cuts = np.searchsorted(groups[:, 0], first)
                first_b = np.append(t.first_b, len(t.b))
                for k, i in enumerate(t.docs.tolist()):
                    own = groups[cuts[k] : cuts[k + 1]]
                    rows[start + i] = (
                        t.a[first[k] : first[k + 1]].astype(np.int32),
                        t.b[first_b[k] : first_b[k + 1]].astype(np.int32),
                        (own[:, 1] - own[:, 0]).astype(np.int32),
                        (own[:, 3] - own[:, 2]).astype(np.int32),
                    )
            yield pd.DataFrame(rows, columns=["a_ids", "b_ids", "a_sizes", "b_sizes"])

    return documents.withColumn(name, align(F.col("text")))


_FEATURES = "row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"


def link_features(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, an own number for each row, the counts, the digest of the groups and the packed pairs."""
    spark = documents.sparkSession
    files = read_files(spark, path_a, path_b)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, spelling = _loaded(files)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = batch.column(1)
            for start, stop in stretches(pc.binary_length(texts).to_pylist(), BATCH_BYTES):
                t = pair.tokens(texts[start:stop].to_pylist())
                groups = lockstep(t)
                n = stop - start
                columns = {k: np.zeros(n, np.int64) for k in ("n_a", "n_b", "n_groups", "n_links")}
                digests, packed = [""] * n, [None] * n
                if len(t.docs):
                    k = np.searchsorted(t.first_a, groups[:, 0], side="right") - 1
                    doc, codes, times = linked_ids(t, groups, k, pair.size_b)
                    columns["n_a"][t.docs] = np.diff(t.first_a, append=len(t.a))
                    columns["n_b"][t.docs] = np.diff(t.first_b, append=len(t.b))
                    columns["n_groups"][t.docs] = np.bincount(k, minlength=len(t.docs))
                    links = (groups[:, 1] - groups[:, 0]) * (groups[:, 3] - groups[:, 2])
                    columns["n_links"][t.docs] = np.add.reduceat(links, np.searchsorted(k, np.arange(len(t.docs))))
                    cuts = np.searchsorted(doc, np.arange(len(t.docs) + 1)).tolist()
                    for j, (i, digest) in enumerate(zip(t.docs.tolist(), spelling.digests(t, groups))):
                        digests[i] = digest
                        packed[i] = pack(codes[cuts[j] : cuts[j + 1]], times[cuts[j] : cuts[j + 1]])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[start:stop],
                        pa.array(row + np.arange(n)),
                        *(pa.array(c) for c in columns.values()),
                        pa.array(digests, pa.string()),
                        pa.array(packed, pa.binary()),
                    ],
                    ["doc_id", "row", *columns, "groups_sha256", "pairs"],
                )
                row += n

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(features, f"doc_id {kind}, {_FEATURES}")


def _pairs_of(batch: pa.RecordBatch, place: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the batch, code, links) of all packed pairs."""
    rows, codes, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, raw in enumerate(batch.column(place).to_pylist()):
        if raw is not None:
            own, n = unpack(raw)
            rows.append(np.full(len(own), i))
            codes.append(own)
            times.append(n)
    return np.concatenate(rows), np.concatenate(codes), np.concatenate(times)


def pair_counts(features: DataFrame, size_b: int) -> DataFrame:
    """(code, n, best): in how many documents a pair is linked, and whether no pair of the same A id is in more."""

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                _, codes, _ = _pairs_of(batch[start : start + 1000], 0)
                found, n = np.unique(codes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["code", "n"])

    held_by = features.select("pairs").mapInArrow(held, "code long, n long")
    counted = held_by.groupBy("code").agg(F.sum("n").alias("n"))
    # One A id has at most as many pairs as B has ids.
    most = F.max("n").over(Window.partitionBy(F.floor(F.col("code") / size_b)))
    return counted.select("code", "n", (F.col("n") == most).alias("best"))


def _most_frequent(counts: DataFrame, bound: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """At most ``bound`` of the most frequent pairs, as sorted codes, counts and marks."""
    level = F.floor(8 * F.log2(F.col("n").cast("double"))).cast("int")
    sizes = counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    least, total = None, 0
    for row in sizes:
        total += row["count"]
        if total > bound:
            break
        least = row["level"]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    table = counts.filter(level >= least).toArrow().sort_by("code")
    return tuple(table.column(c).to_numpy() for c in ("code", "n", "best"))


def with_link_counts(features: DataFrame, size_b: int, hot: int = HOT) -> DataFrame:
    """Written ``link_features`` with n_best and count_sum instead of the packed pairs.

    n_best counts the links whose pair no other pair of its A id beats, count_sum adds up the
    documents that hold each link's pair.
    """
    spark = features.sparkSession
    scratch = Scratch(spark)
    counts = scratch.stage(pair_counts(features, size_b), "pairs")
    frequent = spark.sparkContext.broadcast(_most_frequent(counts, hot))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes_of, n_of, best_of = frequent.value
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole[start : start + 1000]
                rows, codes, times = _pairs_of(batch, batch.num_columns - 1)
                if len(codes_of):
                    at = np.minimum(np.searchsorted(codes_of, codes), len(codes_of) - 1)
                    known = codes_of[at] == codes
                else:
                    at, known = np.zeros(len(codes), np.int64), np.zeros(len(codes), bool)
                best, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
                np.add.at(total, rows[known], n_of[at[known]] * times[known])
                np.add.at(best, rows[known], best_of[at[known]] * times[known])
                rare = np.searchsorted(rows[~known], np.arange(batch.num_rows + 1))
                links = pa.StructArray.from_arrays([pa.array(codes[~known]), pa.array(times[~known])], ["code", "times"])
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:-1],
                        pa.array(best),
                        pa.array(total),
                        pa.ListArray.from_arrays(pa.array(rare, pa.int32()), links),
                    ],
                    [*batch.schema.names[:-1], "n_best", "count_sum", "rare"],
                )

    kind = features.schema["doc_id"].dataType.simpleString()
    shape = _FEATURES.replace("pairs binary", "n_best long, count_sum long, rare array<struct<code:long,times:long>>")
    looked = scratch.stage(features.mapInArrow(look_up, f"doc_id {kind}, {shape}"), "looked-up")
    rare = looked.select("row", F.explode("rare").alias("link")).select("row", "link.code", "link.times")
    found = rare.join(counts, "code").groupBy("row")
    more = found.agg(F.sum(F.col("times") * F.col("n")).alias("_sum"), F.sum(F.when(F.col("best"), F.col("times"))).alias("_best"))
    add = lambda name, extra: (F.col(name) + F.coalesce(F.col(extra), F.lit(0))).alias(name)
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", add("n_best", "_best"), add("count_sum", "_sum"), "groups_sha256"]
    return looked.drop("rare").join(more, "row", "left").select(*kept)


def linked_pairs(documents: DataFrame, path_a: str, path_b: str, hot: int = HOT) -> DataFrame:
    """Per row of ``documents``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    features = Scratch(documents.sparkSession).stage(link_features(documents, path_a, path_b), "links")
    return with_link_counts(features, size_b, hot)
