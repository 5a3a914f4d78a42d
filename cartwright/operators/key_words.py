"""Sets of whole numbers as bitmaps of 64, built where the rows are.

A key's word is its value without the last six bits, which say the bit. A task hands on one row a word,
so dense keys, such as surrogate keys stored in their order, shuffle a bit or little more
each, and sparse ones a row each as a plain grouping would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BITS = 6


def word_of(key: Column) -> Column:
    return F.shiftright(key, WORD_BITS)


def bit_of(key: Column) -> Column:
    """A number with the key's bit only."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), key.bitwiseAND(F.lit(63)).cast("int"))


def words(keys: DataFrame, *by: str, key: str = "key") -> DataFrame:
    """(by, word, bits, rows): the keys of each word, and how many rows have them; null keys have the null word."""
    marked = keys.select(*by, word_of(F.col(key)).alias("word"), bit_of(F.col(key)).alias("_bit"))
    return marked.groupBy(*by, "word").agg(F.bit_or("_bit").alias("bits"), F.count(F.lit(1)).alias("rows"))


def distinct_in(bits: Column) -> Column:
    return F.coalesce(F.bit_count(bits), F.lit(0))
