"""Mixing sources to target weights that may change over training.

1. A schedule gives each source's weight in consecutive phases of training (``until``: the phase's
   end, from 0 to 1). Within a phase a source's share is its weight over all weights; its
   demand is the integral of its share over training.
2. The demand of all sources is as large as all documents together. A source that is asked for
   more than ``cap`` times its size stops there, and what is over goes to the others by demand,
   until none is above.
3. Each source's documents are put in the order of a hash and repeated as often as needed. A
   document takes the words of the source's stream from the running total before it; what the
   target covers of them is taken. The last document of a source may be taken in part, so
   that the words taken are the target, rounded.
4. The running total is turned into a training position by inverting the source's cumulative
   demand: copy e of a document stands where the source's stream is at the document's start and
   e times the source's size. ``mix`` has one row a document, range-sorted by the position of its
   first copy; ``in_training_order`` has one row for each copy, range-sorted by the copy's own position.

Running totals never need a whole source in one task: a source's order is cut into stretches of the hash, totals
run within stretches, and the stretches' sums are added up (a few thousand rows a source).

Defined cases: null texts have size 0; nothing is taken of size 0, of sources of size 0 or
without weight. A null source is a source of its own. Repeated rows count each; rows without an id are told apart by their texts. If the weighted
sources can't cover all words within the cap, each is taken up to it. Columns of the
documents are kept; result columns replace equally named ones. An empty table gives an empty one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.llm.common import WORD, shuffle_partitions
from cartwright.sources.scratch import Scratch

CAP = 3
_UNIT = 1e12  # demand is counted in whole parts of a million millionth, so sums have no order


def source_key(source: Column) -> Column:
    """Sources in the order of code points, null last; never null."""
    return F.when(source.isNotNull(), F.concat(F.lit("0"), source)).otherwise(F.lit("1"))


def rotating_weights(sources: DataFrame, weights: tuple[float, ...] = (1, 2, 3)) -> DataFrame:
    """A schedule of one phase: the sources' ranks go through ``weights`` again and again.

    ``sources`` has one row (_key) for each source: as many rows as the mix has sources.
    """
    rank = F.row_number().over(Window.orderBy("_key")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    return sources.select("_key", F.lit(1.0).alias("until"), weight.alias("weight"))


def targets(sources: DataFrame, schedule: DataFrame, cap: int = CAP) -> DataFrame:
    """(_key, source_size, target, phases) from (_key, source_size) and the schedule
    (_key, until, weight). Both have a few rows for each source.
    """
    everything = Window.partitionBy()
    phase = Window.partitionBy("until")
    earlier = F.filter(F.collect_set("until").over(everything), lambda x: x < F.col("until"))
    own = Window.partitionBy("_key").orderBy("until")
    share = F.col("weight") / F.sum("weight").over(phase)
    part = F.floor(F.coalesce(share, F.lit(0.0)) * (F.col("until") - F.col("since")) * _UNIT + 0.5)
    parts = (
        schedule.withColumn("since", F.coalesce(F.array_max(earlier), F.lit(0.0)))
        .withColumn("part", F.when(F.col("weight") > 0, part).otherwise(F.lit(0)).cast("bigint"))
        .withColumn("reached", F.sum("part").over(own))
        .groupBy("_key")
        .agg(
            F.sum("part").alias("demand"),
            F.array_sort(F.collect_list(F.struct("until", "since", "part", "reached"))).alias("phases"),
        )
    )
    limit = F.col("limit")
    by_room = Window.orderBy("room", "_key")
    rows = (
        sources.join(parts, "_key", "left")
        .withColumn("demand", F.coalesce("demand", F.lit(0).cast("bigint")))
        .withColumn("limit", F.col("source_size") * cap)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("room", F.when(F.col("demand") > 0, limit.cast("double") / F.col("demand")))
        .withColumn("room", F.coalesce("room", F.lit(math.inf)))
        .withColumn("limits_before", F.sum("limit").over(by_room) - limit)
        .withColumn(
            "demand_left",
            F.sum("demand").over(everything) - F.sum("demand").over(by_room) + F.col("demand"),
        )
    )
    full = (F.col("demand") > 0) & (
        limit.cast("double") * F.col("demand_left").cast("double")
        <= F.col("demand").cast("double") * (F.col("total") - F.col("limits_before")).cast("double")
    )
    rows = rows.withColumn("full", full)
    over = F.sum(F.when(F.col("full"), limit).otherwise(F.lit(0))).over(everything)
    open_demand = F.sum(F.when(F.col("full"), F.lit(0)).otherwise(F.col("demand"))).over(everything)
    rows = rows.withColumn("rest", F.col("total") - over).withColumn("open_demand", open_demand)
    target = (
        F.when(F.col("full"), limit.cast("double"))
        .when(F.col("demand") == 0, F.lit(0.0))
        .otherwise(F.col("demand").cast("double") * F.col("rest").cast("double") / F.col("open_demand").cast("double"))
    )
    return rows.select("_key", "source_size", target.alias("target"), "phases", "demand")


def _position(offset: Column) -> Column:
    """Where training stands when the source's stream is at ``offset``."""
    reached = offset.cast("double") / F.col("target") * F.col("demand").cast("double")
    phase = F.element_at(
        F.filter("phases", lambda p: (p["part"] > 0) & (p["reached"].cast("double") > reached)), 1
    )
    inside = (reached - (phase["reached"] - phase["part"]).cast("double")) / phase["part"].cast("double")
    return phase["since"] + inside * (phase["until"] - phase["since"])


RESULTS = ("size", "source_size", "target", "taken", "copies", "position", "positions")


def mix(
    documents: DataFrame,
    schedule: DataFrame | None = None,
    cap: int = CAP,
    seed: str = "mix",
) -> DataFrame:
    """``documents`` (doc_id, text, source, ...) with size, source_size, target, taken, copies, position
    (of the first copy, null where nothing is taken) and positions (of every copy), range-sorted by position.

    ``schedule`` has (source, until, weight); without it the weights rotate through 1, 2, 3.
    """
    taken = _taken(documents, schedule, cap, seed)
    return taken.orderBy(F.col("position").asc_nulls_last(), "_tag").select(*_own(documents, RESULTS), *RESULTS)


def in_training_order(
    documents: DataFrame,
    schedule: DataFrame | None = None,
    cap: int = CAP,
    seed: str = "mix",
) -> DataFrame:
    """One row for each copy of which words are taken, range-sorted by the copy's position.

    Columns as in ``mix``, where taken and copies are the document's; position is the copy's own. Added
    are copy (from 1) and copy_taken, the words taken of this copy. Sums over copies: copy_taken.
    """
    taken = _taken(documents, schedule, cap, seed)
    whole = [c for c in RESULTS if c not in ("position", "positions")]
    each = taken.select(*_hidden(documents).values(), *whole, "_tag", F.posexplode("positions").alias("_copy", "position"))
    # All copies but a document's last are whole.
    words = F.least(F.col("size"), F.col("taken") - F.col("size") * F.col("_copy"))
    own = _own(documents, (*whole, "copy", "copy_taken", "position", "positions"))
    return each.orderBy("position", "_tag").select(
        *own, *whole, (F.col("_copy") + 1).alias("copy"), words.alias("copy_taken"), "position"
    )


def _hidden(documents: DataFrame) -> dict[str, str]:
    """Names for the documents' columns that nothing else here has."""
    return {c: f"_document_{i}" for i, c in enumerate(documents.columns)}


def _own(documents: DataFrame, results: tuple[str, ...]) -> list[Column]:
    """The documents' columns under their own names, without those that ``results`` replace."""
    return [F.col(h).alias(c) for c, h in _hidden(documents).items() if c.lower() not in results]


def _taken(documents: DataFrame, schedule: DataFrame | None, cap: int, seed: str) -> DataFrame:
    """The unsorted mix with _tag; the documents' columns under hidden names."""
    spark = documents.sparkSession
    hidden = _hidden(documents)
    doc_id, text, source = (F.col(hidden[c]) for c in ("doc_id", "text", "source"))
    words = F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("bigint")
    words = F.when(text.isNull(), F.lit(0).cast("bigint")).otherwise(words)
    # Position in the source's order: a hash of the id, without one of the text; equal ones by size.
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("without id "), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))
    tag = F.md5(F.concat_ws(":", F.lit(seed), name).cast("binary"))
    stretches = 4 * shuffle_partitions(spark)
    stretch = F.floor(F.conv(F.substring("_tag", 1, 8), 16, 10).cast("bigint") * stretches / (1 << 32))
    sized = (
        documents.select(*[F.col(f"`{c}`").alias(h) for c, h in hidden.items()])
        .withColumn("size", words)
        .withColumn("_key", source_key(source))
        .withColumn("_tag", tag)
        .withColumn("_stretch", stretch.cast("int"))
    )
    # One narrow pass over the texts gives the sums of all stretches.
    sums = Scratch(spark).stage(sized.groupBy("_key", "_stretch").agg(F.sum("size").alias("sum")), "stretches")
    before = Window.partitionBy("_key").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_key", "_stretch", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("_offset"))
    sources = sums.groupBy("_key").agg(F.sum("sum").alias("source_size"))
    if schedule is None:
        weights = rotating_weights(sources.select("_key"))
    else:
        weights = schedule.select(source_key(F.col("source")).alias("_key"), "until", "weight")
    by_source = targets(sources, weights, cap)
    stretch_rows = offsets.join(by_source, "_key")
    order = Window.partitionBy("_key", "_stretch").orderBy("_tag", "size").rowsBetween(Window.unboundedPreceding, 0)
    start = F.col("_offset") + F.col("_start")
    wanted = F.floor(F.col("target") + 0.5).cast("bigint")
    copies = [
        F.greatest(
            F.lit(0).cast("bigint"),
            F.least(F.col("size"), wanted - F.col("source_size") * e - start),
        )
        for e in range(cap)
    ]
    places = [F.when(c > 0, _position(start + F.col("source_size") * e)) for e, c in enumerate(copies)]
    # Every stretch has its sum, so the inner join loses no row.
    return (
        sized.withColumn("_start", F.sum("size").over(order) - F.col("size"))
        .join(stretch_rows, ["_key", "_stretch"])
        .withColumn("taken", sum(copies[1:], copies[0]))
        .withColumn("copies", sum(((c > 0).cast("int") for c in copies[1:]), (copies[0] > 0).cast("int")))
        .withColumn("position", F.when(F.col("taken") > 0, _position(start)))
        .withColumn("positions", F.array_compact(F.array(*places)))
    )
