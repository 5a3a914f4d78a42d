"""Row-level band join: pairs of rows of one key whose days are at most so far apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one key and day beyond this are dealt to several pieces.
BUSY = 100_000


def within_days(
    left: DataFrame,
    right: DataFrame,
    *,
    key: tuple[str, str],
    day: tuple[str, str],
    days: int,
    busy: int = BUSY,
) -> DataFrame:
    """Every pair of a left and a right row with the same key and right day in [left day, left day + days].

    A left row reaches days + 1 days, so it is repeated once a day and pairs meet by equality of key and
    day: what the join puts out are true pairs only, each once, whatever the rest of the key's rows are. Days of a key with more than ``busy`` right rows are
    dealt to pieces by the row's content, and the left rows of those days to every piece, so that no task has all
    pairs of a busy key. Null keys and days are in no pair. Column names of both sides must differ.
    """
    clash = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    (left_key, right_key), (left_day, right_day) = key, day
    reach = F.sequence(F.col(left_day), F.date_add(F.col(left_day), days))
    at_left = left.where(F.col(left_key).isNotNull() & F.col(left_day).isNotNull()).select(
        "*", F.col(left_key).alias("_key"), F.explode(reach).alias("_day")
    )
    at_right = right.where(F.col(right_key).isNotNull() & F.col(right_day).isNotNull()).select(
        "*", F.col(right_key).alias("_key"), F.col(right_day).alias("_day")
    )
    # Counted where the rows are; only days beyond the bound are left.
    crowded = (
        at_right.groupBy("_key", "_day")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > busy)
        .select("_key", "_day", F.ceil(F.col("_n") / busy).cast("int").alias("_pieces"))
    )

    def dealt(side: DataFrame, piece: Column) -> DataFrame:
        return side.join(crowded, ["_key", "_day"], "left").withColumn("_piece", piece)

    one = F.coalesce("_pieces", F.lit(1))
    every = dealt(at_left, F.explode(F.sequence(F.lit(0), one - 1)))
    own = dealt(at_right, F.pmod(F.xxhash64(*right.columns), one).cast("int"))
    return every.join(own.drop("_pieces"), ["_key", "_day", "_piece"]).select(*left.columns, *right.columns)
