"""Left joins of a fact to a dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.operators.key_words import bit_of, distinct_in, word_of

#: So many words of 64 keys are broadcast, 24 bytes each.
MOST_WORDS = 1 << 21
#: Words that hold fewer keys on average are no shorter way than the keys.
LEAST_KEYS = 8


def lookup(
    df: DataFrame,
    dimension: DataFrame,
    key: Column | str,
    dimension_key: str,
    take: dict[str, str],
    fixed_size: bool = False,
) -> DataFrame:
    """Add columns of ``dimension`` to every row of ``df``; no match gives NULLs.

    ``take`` maps dimension columns to output names; only those and the key travel. The hint
    is for tables of a fixed size (seeds, the calendar). For any other dimension Spark
    compares its measured size with ``autoBroadcastJoinThreshold`` and otherwise shuffles
    both sides, splitting hot keys at run time (adaptive skew join).
    """
    right = dimension.select(
        F.col(dimension_key).alias("_key"), *[F.col(c).alias(n) for c, n in take.items()]
    )
    if fixed_size:
        right = F.broadcast(right)
    key = F.col(key) if isinstance(key, str) else key
    return df.join(right, key == F.col("_key"), "left").drop("_key")


def lookup_number(df: DataFrame, numbered: DataFrame, key: str, number: str) -> DataFrame:
    """``lookup`` of ``number`` by ``key`` in rows that ``dense_key`` has numbered in the order of ``key`` first.

    Where no key repeats, a key's number is that of the least key of its bitmap word and how many of the word come before
    it. Words are broadcast, 24 bytes for up to 64 keys, and ``df`` is not shuffled. Repeated keys, sparse ones or more words
    than ``MOST_WORDS`` take the plain lookup.
    """
    whole = F.col(key).cast("bigint")
    each = numbered.where(F.col(key).isNotNull()).groupBy(word_of(whole).alias("_word"))
    held = each.agg(
        F.bit_or(bit_of(whole)).alias("_bits"),
        F.count(F.lit(1)).alias("_rows"),
        F.min(number).cast("bigint").alias("_first"),
        F.max(number).cast("bigint").alias("_last"),
    )
    plain = (F.col("_rows") == distinct_in(F.col("_bits"))) & (F.col("_last") - F.col("_first") + 1 == F.col("_rows"))
    found = held.agg(F.count(F.lit(1)).alias("words"), F.sum("_rows").alias("rows"), F.bool_and(plain).alias("plain")).first()
    if not found["plain"] or found["words"] > MOST_WORDS or found["words"] * LEAST_KEYS > found["rows"]:
        return lookup(df, numbered, key, key, {number: number})
    place = whole.bitwiseAND(F.lit(63)).cast("int")
    below = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("bigint"), place))
    at = F.col("_first") + F.bit_count(F.col("_bits").bitwiseAND(below))
    hit = F.col("_bits").bitwiseAND(bit_of(whole)) != 0
    # Bounded by MOST_WORDS.
    words = F.broadcast(held.select("_word", "_bits", "_first"))
    rows = df.join(words, word_of(whole) == F.col("_word"), "left")
    return rows.withColumn(number, F.when(hit, at).cast(numbered.schema[number].dataType)).drop("_word", "_bits", "_first")
