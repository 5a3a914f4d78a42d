"""Credit outcomes to the touches that preceded them within some days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_credit(
    touches: DataFrame,
    outcomes: DataFrame,
    *,
    campaign: str,
    person: str,
    touch_day: str,
    outcome_id: str,
    outcome_day: str,
    amount: str,
    days: int = 7,
) -> DataFrame:
    """Per campaign: amount credited and distinct outcomes credited.

    An outcome is credited to a touch of the same person when its day lies in
    ``[touch day, touch day + days]``. The amount counts once per such touch, an outcome id
    once per campaign.

    The band join is turned into an equality join between two pre-aggregated sides, so the
    work is linear in both inputs even for a person with very many touches and outcomes:

    * touches become (campaign, person, day) with a weight, each touch reaching days + 1 days;
    * outcomes become one row per (person, day).

    A sum over pairs is then weight x daily amount. Distinct ids are daily counts as long as
    an id occurs on one (person, day) only. Ids that occur on several are credited together
    or not at all if they occur on exactly the same ones, so each such set of places is met with the campaigns
    once, with the number of its ids.
    """
    reach = (
        touches.where(F.col(person).isNotNull() & F.col(touch_day).isNotNull())
        .select(
            F.col(campaign).alias("campaign"),
            F.col(person).alias("person"),
            F.explode(F.sequence(F.col(touch_day), F.date_add(F.col(touch_day), days))).alias("day"),
        )
        .groupBy("campaign", "person", "day")
        .agg(F.count(F.lit(1)).cast("decimal(10,0)").alias("weight"))
    )
    # One row per id, person and day; an id is "single" when that is its only row.
    per_id = (
        outcomes.where(F.col(person).isNotNull() & F.col(outcome_day).isNotNull())
        .groupBy(
            F.col(outcome_id).alias("id"),
            F.col(person).alias("person"),
            F.col(outcome_day).alias("day"),
        )
        .agg(F.sum(F.col(amount)).alias("amount"))
    )
    spread = (
        per_id.where(F.col("id").isNotNull())
        .groupBy("id")
        .agg(
            (F.min("person") != F.max("person")).alias("_persons"),
            (F.min("day") != F.max("day")).alias("_days"),
        )
        .where(F.col("_persons") | F.col("_days"))
        .select("id")
    )
    several = per_id.join(spread, "id", "left_semi").select("id", "person", "day")
    daily_all = per_id.groupBy("person", "day").agg(
        F.sum("amount").alias("amount"), F.count("id").alias("ids")
    )
    daily_several = several.groupBy("person", "day").agg(F.count("id").alias("several_ids"))
    daily = daily_all.join(daily_several, ["person", "day"], "left").select(
        "person",
        "day",
        "amount",
        (F.col("ids") - F.coalesce("several_ids", F.lit(0))).alias("single_ids"),
    )
    credited = (
        reach.join(daily, ["person", "day"])
        .groupBy("campaign")
        .agg(
            F.sum(F.col("weight") * F.col("amount")).alias("amount"),
            F.sum("single_ids").alias("outcomes"),
        )
    )
    # A set of places is known by its size and the sum of its places' hashes, in four lanes.
    one = F.xxhash64("person", "day")
    two = F.xxhash64("day", "person", F.lit("second"))
    low = F.lit((1 << 32) - 1)
    lanes = [x for h in (one, two) for x in (F.shiftrightunsigned(h, 32), h.bitwiseAND(low))]
    shape = ["places", "s0", "s1", "s2", "s3"]
    sets = (
        several.groupBy("id")
        .agg(F.count(F.lit(1)).alias("places"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(lanes)])
        .groupBy(*shape)
        .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("ids"))
        .select("id", "ids")
    )
    repeated = (
        reach.join(several.join(sets, "id"), ["person", "day"])
        .select("campaign", "id", "ids")
        .distinct()
        .groupBy("campaign")
        .agg(F.sum("ids").alias("outcomes"))
        .select("campaign", F.lit(None).alias("amount"), "outcomes")
    )
    return (
        credited.select("campaign", "amount", "outcomes")
        .unionByName(repeated)
        .groupBy("campaign")
        .agg(F.sum("amount").alias("amount"), F.sum("outcomes").alias("outcomes"))
    )
