"""Small helpers that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front as long as ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else untouched."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sample_per_class(rows: DataFrame, label: str, key: str, bound: int, seed: str) -> DataFrame:
    """At most ``bound`` rows of each class, the first ones in the order of a seeded hash of
    ``key``. Counting the classes first lets the map side drop nearly all others, so no task
    and not the driver sees much more than the rows asked for.
    """
    counts = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count("*").alias("n")).collect()}
    place = F.xxhash64(F.lit(seed), F.col(key))
    share = F.pmod(place, F.lit(1 << 30)) / float(1 << 30)
    parts = [
        rows.filter((F.col(label) == F.lit(value)) & (share <= 2.0 * bound / n))
        .orderBy(place, key)
        .limit(bound)
        for value, n in sorted(counts.items(), key=lambda x: str(x[0]))
        if value is not None
    ]
    if not parts:
        return rows.limit(0)
    chosen = parts[0]
    for part in parts[1:]:
        chosen = chosen.unionByName(part)
    return chosen
