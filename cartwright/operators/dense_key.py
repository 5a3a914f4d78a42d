"""Dense surrogate keys 1..N in a global order, without a single-partition window."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.operators.key_ranges import Ranges
from cartwright.sources.scratch import Scratch

ROW_TAG = "_row_tag"
#: A range of fewer rows is not worth a task of its own.
ROWS_OF_A_RANGE = 2_000
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def with_row_tag(df: DataFrame) -> DataFrame:
    """Tag the rows of a plain table scan with distinct numbers.

    Meant for scans with row-wise steps only: a task that is run again then reads the same
    split and gives the same tags. It lets equal rows be spread over several range partitions.
    """
    return df.withColumn(ROW_TAG, F.monotonically_increasing_id())


def dense_key(
    df: DataFrame,
    order_by: list[str | Column],
    name: str,
    scratch: Scratch,
    key_type: str = "int",
    order_only: tuple[str, ...] = (),
    narrow: DataFrame | None = None,
) -> DataFrame:
    """Prepend column ``name`` numbering the rows 1..N by ``order_by``, nulls last.

    Columns in ``order_only`` take part in the order and are not kept. ``narrow`` are rows that have about the values
    of the order's first column, or of several first ones, and cost less to compute than ``df``, such as the
    table it was joined from.

    1. Sketch the first column of the order and cut the order into ranges of about as many rows (``key_ranges``).
       Only its number is read. A value held by many rows is cut by the next columns, equal rows by the row
       tag where there is one, so a key with many rows does not end up in one partition.
    2. Send each row to its range, sort it there, note its range and place, and write the
       result once. The rows themselves are evaluated once and copied nowhere else.
    3. Count the rows per partition and add up the counts on the driver: one number per
       partition, however many rows there are. A key is then its partition's offset plus its
       place, so the result is a plain scan of the copy without a join.
    """
    keys = [F.col(k) if isinstance(k, str) else k for k in order_by]
    tag = ROW_TAG if ROW_TAG in df.columns else None
    rows = (df if narrow is None else narrow).count()
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = Ranges(df, keys, min(most, -(-rows // ROWS_OF_A_RANGE)), narrow, tag)
    # Where the order has all columns, rows alike in it are the same, and the tag has done its work with the ranges.
    alike = set(df.columns) - {tag} <= {k for k in order_by if isinstance(k, str)}
    order = [k.asc_nulls_last() for k in (*keys, *([F.col(tag)] if tag and not alike else []))]
    place = F.monotonically_increasing_id()
    placed = (
        ranges.with_range(df, "_range")
        .drop(*([tag] if tag and alike else []))
        .repartitionById(len(ranges.starts) + 1, F.col("_range"))
        .sortWithinPartitions(*order)
        .drop("_range", ROW_TAG, *order_only)
        .withColumn("_place", place)
        .withColumn("_part", F.shiftright("_place", _ROW_BITS).cast("int"))
        .withColumn("_place", F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    )
    staged = scratch.stage(placed, name)
    sizes = staged.groupBy("_part").agg((F.max("_place") + 1).alias("_size")).collect()
    by_part = {row["_part"]: row["_size"] for row in sizes}
    ends = accumulate(by_part.get(part, 0) for part in range(max(by_part, default=0) + 1))
    # A constant array, indexed by partition; the last end is never looked up.
    offsets = F.split(F.lit(",".join(["0", *map(str, ends)])), ",").cast("array<bigint>")
    key = (F.get(offsets, F.col("_part")) + F.col("_place") + 1).cast(key_type)
    kept = [c for c in df.columns if c != ROW_TAG and c not in order_only]
    return staged.select(key.alias(name), *kept)
