"""Chat formatting of logged conversations, of cumulative snapshots only the last.

A log that is written after every turn holds each conversation many times, every copy a prefix of
the next. Each turn gets a rolling hash of all turns up to it. A conversation whose last hash is
the hash of an earlier turn of another, longer one is a prefix of it; an anti join leaves the
maximal conversations, and of identical ones that with the smallest conv_id. They are
rendered with role markers.

The rolling hash is a running sum of the turns' hashes, each taken with the turn's place, in four
lanes of 32 bits; grouping by it combines on the map side, so a first turn that many
conversations share is no hot spot. A conversation is taken for one document: its turns meet in one row.

Defined cases: turns are ordered by turn (nulls last), role, text. A null role is ``unknown``, a null
text empty. Equal rows are separate turns. Turns without conv_id are left out. Marker texts inside a turn or a
role lose their bars, so that they can't open or end a turn, and a role's line ends become blanks. A conversation
of very many turns is one row all the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
_LANES = ["_a", "_b", "_c", "_d"]
_KEY = ["n", *_LANES]


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, role, text, n: place of the turn, turns: of the conversation, four lanes)."""
    clean = turns.filter(F.col("conv_id").isNotNull()).select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = clean.withColumn("n", F.row_number().over(order)).withColumn("turns", F.count("*").over(whole))
    one = F.xxhash64("n", "role", "text")
    two = F.xxhash64("text", "role", "n", F.lit("second"))
    low = F.lit((1 << 32) - 1)
    lanes = [part for h in (one, two) for part in (F.shiftrightunsigned(h, 32), h.bitwiseAND(low))]
    for name, lane in zip(_LANES, lanes):
        placed = placed.withColumn(name, lane)
    return placed.withColumns({name: F.sum(name).over(so_far) for name in _LANES}).drop("turn")


def maximal(hashed: DataFrame) -> DataFrame:
    """(conv_id) of the conversations that are no prefix of another one, one of each identical group."""
    ends = hashed.filter(F.col("n") == F.col("turns")).groupBy(*_KEY).agg(F.min("conv_id").alias("conv_id"))
    inner = hashed.filter(F.col("n") < F.col("turns")).select(*_KEY).distinct()
    return ends.join(inner, _KEY, "left_anti").select("conv_id")


def render(hashed: DataFrame) -> DataFrame:
    """(conv_id, n_turns, rendered)."""
    plain = lambda c: F.regexp_replace(c, r"<\|(im_start|im_end)\|>", "<$1>")
    role = F.translate(plain("role"), "\r\n", "  ")
    piece = F.concat(F.lit(START), role, F.lit("\n"), plain("text"), F.lit(f"{END}\n"))
    pieces = F.array_sort(F.collect_list(F.struct("n", piece.alias("piece"))))
    return hashed.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"), F.array_join(F.transform(pieces, lambda p: p["piece"]), "").alias("rendered")
    )


def format_chats(turns: DataFrame) -> DataFrame:
    """One rendered text for each maximal conversation of ``turns`` (conv_id, turn, role, text)."""
    hashed = prefix_hashes(turns)
    return render(hashed.join(maximal(hashed), "conv_id", "left_semi"))
