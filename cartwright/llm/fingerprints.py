"""Winnowing: a document's fingerprint is the smallest k-gram hash of every window.

A text is cut into words (``[^\\x20\\x09-\\x0D]``, longer than 12 code points in pieces of 12). Where
blanks do not part words, overlapping pieces stand for them, one from each code point on, so that no phase
decides a match: of 4 code points in Chinese and Japanese script, of 12 in Thai, Lao, Khmer, Burmese and Tibetan
script and in runs of other scripts longer than 64. Such a script's run also ends where its script does. The
hash of k consecutive words is composed from the hashes of shorter grams, as in a rolling
polynomial: hash(ab) = hash(a) * base^len(b) + hash(b), modulo 2^31 - 1. From every ``window``
consecutive k-gram hashes the smallest is selected, the rightmost one on a tie, with its position.
So two texts that share k + window - 1 words in a row share a selected hash, and no match
shorter than k words is found. In a run without blanks these are k + window + 2 code points (pieces of 4)
or k + window + 10 (pieces of 12); a run of another script counts as such only if it is long in both texts.

Everything is built-in array functions: the window minimum comes from minima over half as many
places, so a pass costs the same whatever ``window`` is.

Defined cases: null is the empty text, whose fingerprint is empty. Fewer than k words are one
gram; fewer than ``window`` grams are one window. Equal texts have equal fingerprints. The
likeness of two empty fingerprints is 1, of an empty and another one 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.llm.common import fresh, shuffle_partitions

K, WINDOW = 3, 4
PRIME, BASE = (1 << 31) - 1, 1_000_003
PIECE = r"[^\x20\x09-\x0D]{1,12}"
LONG = 64  # A run of more code points is no word, whatever its script.
_DENSE = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsBopomofo}\x{30FC}\x{FF70}"
_JOINED = r"\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}"
_RUN = rf"[{_DENSE}]+|[{_JOINED}]+|[^\x20\x09-\x0D{_DENSE}{_JOINED}]+"
_UNSPACED = rf"[{_DENSE}{_JOINED}]|(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]{{{LONG + 1}}}"
_PLACES = 1 << 31


def _spread(
    df: DataFrame, first: str, length: int, join: Callable[[Column, Column, int], Column]
) -> tuple[DataFrame, str, list[str]]:
    """Add a column that joins every ``length`` neighbours of the array ``first``.

    Each step is a column of its own, so that it is computed once.
    """
    made = {1: first}

    def need(n: int) -> str:
        nonlocal df
        if n not in made:
            right = n // 2
            a, b = need(n - right), need(right)
            size = F.greatest(F.size(first) - (n - 1), F.lit(0))
            name = fresh(df, f"_{first}_{n}")
            df = df.withColumn(
                name,
                F.zip_with(
                    F.slice(F.col(a), F.lit(1), size),
                    F.slice(F.col(b), F.lit(n - right + 1), size),
                    lambda x, y: join(x, y, right),
                ),
            )
            made[n] = name
        return made[n]

    last = need(length)
    return df, last, [c for c in made.values() if c != first]


def _overlapping(run: Column, length: int) -> Column:
    """The pieces of ``length`` code points of a run, one from each code point on; a shorter run itself."""
    pieces = F.regexp_extract_all(run, F.lit(f"(?s)(?=(.{{{length}}}))."), F.lit(1))
    return F.when(F.char_length(run) <= length, F.array(run)).otherwise(pieces)


def _pieces(text: Column) -> Column:
    """What stands for the words of ``text``, which is not null."""

    def of(run: Column) -> Column:
        joined = run.rlike(f"^[{_JOINED}]") | (F.char_length(run) > LONG)
        return (
            F.when(run.rlike(f"^[{_DENSE}]"), _overlapping(run, 4))
            .when(joined, _overlapping(run, 12))
            .otherwise(F.regexp_extract_all(run, F.lit(PIECE), F.lit(0)))
        )

    # Most texts have blanks between words, and need one pass only.
    runs = F.regexp_extract_all(text, F.lit(_RUN), F.lit(0))
    spaced = F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))
    return F.when(text.rlike(_UNSPACED), F.flatten(F.transform(runs, of))).otherwise(spaced)


def with_fingerprint(df: DataFrame, text: str, name: str, k: int = K, window: int = WINDOW) -> DataFrame:
    """``df`` with the selected hashes of ``text`` and their positions, packed in one number each:
    hash * 2^31 + (2^31 - 1 - position), in the order of positions.
    """
    words, packed = fresh(df, "_words"), fresh(df, "_packed")
    pieces = _pieces(F.coalesce(F.col(text), F.lit("")))
    df = df.withColumn(words, F.transform(pieces, lambda w: F.pmod(F.xxhash64(w), F.lit(PRIME))))
    df, grams, made = _spread(df, words, k, lambda x, y, n: (x * pow(BASE, n, PRIME) + y) % PRIME)
    whole = F.array(F.aggregate(F.col(words), F.lit(0).cast("long"), lambda s, x: (s * BASE + x) % PRIME))
    short = F.when(F.size(words) > 0, whole).otherwise(F.col(words))
    df = df.withColumn(
        packed,
        F.transform(
            F.when(F.size(words) < k, short).otherwise(F.col(grams)),
            lambda x, i: x * _PLACES + (_PLACES - 1 - i),
        ),
    )
    df, least, more = _spread(df, packed, window, lambda x, y, n: F.least(x, y))
    lone = F.when(F.size(packed) > 0, F.array(F.array_min(packed))).otherwise(F.col(packed))
    chosen = F.when(F.size(packed) < window, lone).otherwise(F.array_distinct(F.col(least)))
    return df.withColumn(name, chosen).drop(words, packed, *made, *more)


def as_text(fingerprint: Column) -> Column:
    """``hash@position`` of every selection, joined by commas; hashes in hexadecimal."""
    return F.array_join(
        F.transform(
            fingerprint,
            lambda x: F.concat(
                F.lower(F.hex(F.shiftright(x, 31))),
                F.lit("@"),
                (F.lit(_PLACES - 1) - x.bitwiseAND(F.lit(_PLACES - 1))).cast("string"),
            ),
        ),
        ",",
    )


def with_likeness(df: DataFrame, one: str, other: str, name: str) -> DataFrame:
    """``df`` with the shared part of two fingerprints' different hashes (Jaccard)."""
    a, b = fresh(df, "_one"), fresh(df, "_other")
    for short, of in ((a, one), (b, other)):
        df = df.withColumn(short, F.array_distinct(F.transform(F.col(of), lambda x: F.shiftright(x, 31))))
    df = df.withColumn(name, F.size(F.array_intersect(a, b)))
    both = F.size(a) + F.size(b) - F.col(name)
    like = F.when(both == 0, F.lit(1.0)).otherwise(F.col(name) / both)
    return df.withColumn(name, like).drop(a, b)


def beside_next(documents: DataFrame, columns: list[str], add: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Each document with ``columns`` of the next one by doc_id (after the last the first, nulls
    last, equal ids by text), as ``next_...``.

    Ids are dealt into ranges bounded by quantiles of the ids themselves; the documents at a
    bound are sent to the range before as well, so one shuffle of the texts is enough and no
    order over all rows is needed in one task. ``add`` adds columns after that shuffle.
    """
    n = shuffle_partitions(documents.sparkSession)
    share = [i / (4 * n) for i in range(1, 4 * n)]
    found = documents.agg(
        F.percentile_approx("doc_id", share, 100 * n).alias("bounds"), F.min("doc_id").alias("least")
    ).first()
    bounds, least = sorted(set(found["bounds"] or [])), found["least"]
    levels = len(bounds).bit_length()
    padded = bounds + [(1 << 63) - 1] * ((1 << levels) - 1 - len(bounds))
    table = F.split(F.lit(",".join(map(str, padded))), ",").cast("array<bigint>")
    steps = F.array(*[F.lit(1 << s) for s in reversed(range(levels))])
    doc_id = F.col("doc_id")

    def search(low: Column, step: Column) -> Column:
        return F.when(F.get(table, low + step - 1) <= doc_id, low + step).otherwise(low)

    below = F.aggregate(steps, F.lit(0), search) if bounds else F.lit(0)
    last = len(bounds)
    bucket = F.coalesce(F.least(F.lit(last), F.when(doc_id.isNotNull(), below)), F.lit(last))
    at, own = fresh(documents, "_at"), fresh(documents, "_bucket")
    at_bound = F.get(table, F.col(own) - 1) == doc_id
    place = lambda b, halo: F.struct(b.cast("int").alias("bucket"), F.lit(halo).alias("halo"))
    # Without any id, every row is a neighbour of the first one.
    first = doc_id.eqNullSafe(F.lit(least).cast("bigint"))
    places = F.array_compact(
        F.array(
            place(F.col(own), 0),
            F.when((F.col(own) > 0) & at_bound, place(F.col(own) - 1, 1)) if bounds else F.lit(None),
            F.when(first, place(F.lit(last), 2)),
        )
    )
    dealt = (
        documents.withColumn(own, bucket)
        .withColumn(at, F.explode(places))
        .withColumn(own, F.col(at)["bucket"])
        .withColumn(at, F.col(at)["halo"])
        .repartition(n, own)
    )
    dealt = add(dealt)
    order = Window.partitionBy(own).orderBy(at, F.col("doc_id").asc_nulls_last(), "text")
    ahead = {f"next_{c}": F.lead(c).over(order) for c in columns}
    return dealt.withColumns(ahead).filter(F.col(at) == 0).drop(own, at)
