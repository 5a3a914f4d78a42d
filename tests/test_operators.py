import random
from collections import defaultdict
from contextlib import contextmanager
from datetime import date, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwright.operators import (
    dense_key,
    flag_repeated,
    group_minimum,
    keep_latest,
    lookup,
    window_credit,
    with_row_tag,
    within_days,
)
from cartwright.operators.key_ranges import Ranges, range_of
from cartwright.operators.key_words import distinct_in, words
from cartwright.sources.scratch import Scratch


@contextmanager
def settings(spark, **values):
    values = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().toString()


# dense keys


def test_dense_key_numbers_rows_in_global_order(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(50)]), rng.choice("abc"), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b string, c int").repartition(7)
    result = dense_key(df, ["a", "b", "c"], "k", Scratch(spark)).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
    assert sorted(tuple(r) for r in result) == [(i + 1, *row) for i, row in enumerate(ordered)]


def test_dense_key_spreads_a_hot_key_of_equal_rows(spark, tmp_path):
    hot = spark.range(20_000).select(F.lit(5).alias("a"), F.lit("x").alias("b"))
    cold = spark.range(40_000).select((F.col("id") % 1000).cast("int").alias("a"), F.lit("y").alias("b"))
    hot.unionByName(cold).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    scratch = Scratch(spark)
    with settings(spark, shuffle__partitions="8", adaptive__coalescePartitions__enabled="false"):
        keyed = dense_key(with_row_tag(rows), ["a", "b"], "k", scratch)
        stats = keyed.agg(F.count("k"), F.count_distinct("k"), F.min("k"), F.max("k")).first()
    assert tuple(stats) == (60_000, 60_000, 1, 60_000)
    wrong = (
        keyed.groupBy("a").agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("k").alias("n"))
        .where("hi - lo + 1 <> n")
    )
    assert wrong.count() == 0
    staged = spark.read.option("recursiveFileLookup", "true").parquet(scratch.path)
    sizes = [r["count"] for r in staged.groupBy("_part").count().collect()]
    # The ranges of a crowded value come in addition.
    assert len(sizes) >= 8 and max(sizes) < 12_000


def test_dense_key_takes_no_sample_of_rows_and_keeps_no_copy(spark, tmp_path):
    spark.range(30_000).select(F.col("id").alias("k"), F.lit("wide" * 20).alias("w")).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    with settings(spark, shuffle__partitions="6"):
        ranges = Ranges(rows, [F.col("k")], 6)
        dealt = rows.repartitionById(len(ranges.starts) + 1, ranges.of_row())
        assert 5 <= len(ranges.starts) <= 6
        text = plan(dealt)
        assert "InMemoryRelation" not in text and "rangepartitioning" not in text
        sizes = [len(p) for p in dealt.select("k").rdd.glom().collect()]
    assert max(sizes) < 1.3 * 30_000 / 6 and sum(sizes) == 30_000


KEY_TYPES = {
    "bigint": "CAST(id % 7 AS BIGINT)",
    "date": "date_add(DATE'2020-01-01', CAST(id % 5 AS INT))",
    "ntz": "TIMESTAMP_NTZ'2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, (id % 3) / 4)",
    "decimal": "CAST(id % 11 - 5 AS DECIMAL(9,2)) / 4",
    "text": "concat('some long common start ', substr('zyxwvutsrqponmlkjihgfedcba', 1 + CAST(id % 9 AS INT)))",
    "double": "(id % 13) / 7D",
    "nulls": "CASE WHEN id % 3 > 0 THEN id % 50 END",
}


@pytest.mark.parametrize("kind", KEY_TYPES)
def test_dense_key_follows_the_order_of_any_type(spark, kind):
    rows = spark.range(9000).selectExpr(f"{KEY_TYPES[kind]} AS k", "CAST(id % 100 AS STRING) AS b", "9000 - id AS c")
    with settings(spark, shuffle__partitions="5"):
        keyed = dense_key(rows, ["k", "b", "c"], "n", Scratch(spark))
        order = Window.orderBy(*[F.col(x).asc_nulls_last() for x in ("k", "b", "c")])
        wrong = keyed.withColumn("want", F.row_number().over(order)).where("n <> want")
        assert wrong.count() == 0 and keyed.count() == 9000


def test_ranges_of_a_crowded_value_go_on_with_the_next_columns(spark):
    rows = spark.range(12_000).selectExpr("IF(id % 3 > 0, 4, id) AS a", "concat('c', id % 10) AS b", "id AS c")
    ranges = Ranges(rows, [F.col("a"), F.col("b"), F.col("c")], 10)
    sizes = [r["count"] for r in rows.groupBy(ranges.of_row().alias("r")).count().collect()]
    assert max(sizes) < 2.2 * 1200 and any(len(s) > 1 for s in ranges.starts)


def test_the_codes_of_a_row_are_computed_once_in_the_search_for_its_range(spark):
    texts = spark.range(64).select(F.concat(F.lit("n"), F.col("id") % 8).alias("t"), F.col("id").alias("i"))
    starts = [(1,), (1, 4), (3,), (3, 2), (3, 9), (6,)]
    codes = [F.conv(F.substring("t", 2, 1), 16, 10).cast("bigint"), F.col("i")]
    found = texts.withColumn("r", range_of(codes, starts))
    assert plan(found).split("== Physical Plan ==")[1].count("conv(") == 1
    for row in found.collect():
        own = (int(row.t[1:]), row.i)
        # A start without a second number comes before all that have one.
        assert row.r == sum((*s, float("-inf"))[:2] <= own for s in starts)


def test_dense_key_of_nothing(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert dense_key(empty, ["a"], "k", Scratch(spark)).collect() == []


def test_dense_key_result_is_a_plain_scan(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") * 2).alias("twice"))
    keyed = dense_key(df, ["id"], "k", Scratch(spark))
    text = keyed.select("twice").explain(mode="formatted") or plan(keyed.select("twice"))
    assert "Join" not in text and "Exchange" not in text
    assert "ReadSchema: struct<twice:bigint>" in text


def test_scratch_space_is_the_folder_the_session_names(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    scratch = Scratch(spark)
    assert scratch.path.startswith(root)
    staged = scratch.stage(spark.range(3), "t")
    assert staged.inputFiles()[0].removeprefix("file:").lstrip("/").startswith(root.lstrip("/"))
    scratch.release()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(scratch.path).count()


# groups


def test_keep_latest_breaks_ties_by_content_and_limits_before_the_shuffle(spark):
    rows = [(1, 10, "b"), (1, 10, "a"), (1, 9, "0"), (2, None, "z"), (2, 1, "y"), (None, 1, "n")]
    df = spark.createDataFrame(rows, "k int, t int, v string")
    latest = keep_latest(df, "k", "t")
    assert sorted(map(tuple, latest.collect()), key=str) == [(1, 10, "a"), (2, 1, "y"), (None, 1, "n")]
    assert "WindowGroupLimit" in plan(latest)


def test_flag_repeated_treats_nulls_alike(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None)], "i int, v string")
    result = {r.i: r.dup for r in flag_repeated(df, "v", "dup").collect()}
    assert result == {1: True, 2: True, 3: False, 4: True, 5: True}


def test_group_minimum_with_and_without_hint(spark):
    df = spark.createDataFrame(
        [(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None)], "i int, v string"
    )
    flagged = flag_repeated(df, "v", "dup")
    expected = {1: 1, 2: 1, 3: 3}
    assert {r.i: r.m for r in group_minimum(df, "v", "i", "m").collect()} == expected
    hinted = group_minimum(flagged, "v", "i", "m", repeated=F.col("dup"))
    assert {r.i: r.m for r in hinted.collect()} == expected


# lookups


def test_lookup_keeps_every_row_and_repeats_for_repeated_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "i int, k string")
    right = spark.createDataFrame([("a", 7), ("a", 8)], "k string, v int")
    result = lookup(left, right, "k", "k", {"v": "got"}).collect()
    assert sorted((r.i, r.got) for r in result if r.i == 1) == [(1, 7), (1, 8)]
    assert sorted(r.i for r in result if r.got is None) == [2, 3]


def test_lookup_splits_a_hot_key(spark):
    """A key with a third of the rows is split over several tasks at run time."""
    big = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    dimension = spark.range(300_000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    with settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        shuffle__partitions="16",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="200KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="200KB",
    ):
        joined = lookup(big.repartition(8), dimension, "k", "key", {"v": "v"})
        counted = joined.groupBy((F.col("v") == 14).alias("hot")).agg(
            F.count("v").alias("n"), F.max("payload")
        )
        assert {r.hot: r.n for r in counted.collect()}[True] >= 100_000
        assert "skew=true" in plan(counted)


# attribution


def brute_force(touches, outcomes, days):
    amount, ids = defaultdict(D), defaultdict(set)
    for campaign, person, sent in touches:
        for oid, who, day, value in outcomes:
            if None in (person, who, sent, day) or person != who:
                continue
            if 0 <= (day - sent).days <= days:
                amount[campaign] += value
                ids[campaign].add(oid)
    return {c: (amount[c], len(ids[c] - {None})) for c in amount}


def credit(spark, touches, outcomes, days=7):
    result = window_credit(
        spark.createDataFrame(touches, "c string, p int, d date"),
        spark.createDataFrame(outcomes, "o int, p int, d date, amount decimal(18,2)"),
        campaign="c",
        person="p",
        touch_day="d",
        outcome_id="o",
        outcome_day="d",
        amount="amount",
        days=days,
    )
    return {r.campaign: (r.amount, r.outcomes) for r in result.collect()}, result


DAY = date(2026, 3, 1)


def test_attribution_window_edges_and_repeated_sends(spark):
    touches = [("c", 1, DAY), ("c", 1, DAY), ("d", 1, DAY)]
    outcomes = [(o, 1, DAY + timedelta(days=n), D("10.00")) for o, n in ((1, 0), (2, 7), (3, 8), (4, -1))]
    result, _ = credit(spark, touches, outcomes)
    assert result == {"c": (D("40.00"), 2), "d": (D("20.00"), 2)}


def test_attribution_equals_brute_force(spark):
    rng = random.Random(3)
    touches = [
        (rng.choice("abcd"), rng.choice([None, 1, 1, 1, 2, 3]), DAY + timedelta(days=rng.randrange(25)))
        for _ in range(120)
    ]
    # Ids repeat within a day, across days and across people.
    outcomes = [
        (
            rng.choice([None, *range(60)]),
            rng.choice([None, 1, 1, 1, 2, 3]),
            DAY + timedelta(days=rng.randrange(30)),
            D(rng.randrange(1, 10_000)) / 100,
        )
        for _ in range(150)
    ]
    result, frame = credit(spark, touches, outcomes)
    assert result == brute_force(touches, outcomes, 7)
    text = plan(frame)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_attribution_of_many_repeated_ids(spark):
    """Ids on the same places meet the campaigns once, however many they are."""
    touches = [(f"c{i % 40}", 1, DAY + timedelta(days=i % 3)) for i in range(200)]
    outcomes = [(o, 1, DAY + timedelta(days=n), D("1.00")) for o in range(300) for n in (o % 2, 9)]
    result, frame = credit(spark, touches, outcomes)
    assert result == brute_force(touches, outcomes, 7)
    # 40 campaigns and two sets of two places, not 300 ids.
    executed = frame._jdf.queryExecution().executedPlan().toString()
    assert executed.count("HashAggregate") > 0
    met = [int(x) for x in output_rows(frame, "SortMergeJoin", "BroadcastHashJoin")]
    assert max(met) <= 2 * 40 * 10 + 600


def output_rows(frame, *nodes):
    """Rows that the named operators of an executed plan put out."""
    found, stack = [], [frame._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            stack.append(node.executedPlan())
            continue
        if hasattr(node, "plan") and name.endswith("QueryStage"):
            stack.append(node.plan())
            continue
        if any(name.startswith(n) for n in nodes):
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return found


def test_dense_key_evaluates_its_input_once(spark):
    counter = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(i):
        counter.add(1)
        return -i

    rows = spark.range(0, 1500, 1, 4).withColumn("k", counted("id"))
    keyed = dense_key(rows, ["id", "k"], "n", Scratch(spark), narrow=spark.range(1500))
    assert keyed.agg(F.max("n")).first()[0] == 1500
    assert counter.value == 1500


def test_ranges_of_several_columns_come_from_the_narrow_rows(spark):
    counter = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(i):
        counter.add(1)
        return i

    # Whatever is read of the rows counts them.
    narrow = spark.range(0, 9000, 1, 4).select(F.lit(1).alias("day"), (F.col("id") % 900).alias("who"), "id")
    rows = narrow.where(counted("id") >= 0).withColumnRenamed("id", "k")
    with settings(spark, shuffle__partitions="4"):
        keyed = dense_key(rows, ["day", "who", "k"], "n", Scratch(spark), narrow=narrow.select("day", "who"))
        order = Window.orderBy("who", "k")
        assert keyed.withColumn("want", F.row_number().over(order)).where("n <> want").count() == 0
    assert counter.value == 9000


# band join


def band_rows(spark, seed, n, people):
    rng = random.Random(seed)
    days = [date(2026, 1, 1) + timedelta(days=i) for i in range(40)]
    left = [(i, rng.choice(people), rng.choice([*days, None])) for i in range(n)]
    right = [(i, rng.choice(people), rng.choice([*days, None])) for i in range(n)]
    return (
        left,
        right,
        spark.createDataFrame(left, "a int, person int, sent date"),
        spark.createDataFrame(right, "b int, buyer int, placed date"),
    )


@pytest.mark.parametrize("busy", [100_000, 3, 1])
def test_band_join_gives_every_pair_once(spark, busy):
    left, right, x, y = band_rows(spark, 5, 300, [1, 1, 1, 2, 3, 4, None])
    want = sorted(
        (a, b)
        for a, p, s in left
        for b, q, d in right
        if p is not None and p == q and s and d and 0 <= (d - s).days <= 7
    )
    pairs = within_days(x, y, key=("person", "buyer"), day=("sent", "placed"), days=7, busy=busy)
    assert pairs.columns == ["a", "person", "sent", "b", "buyer", "placed"]
    assert sorted((r.a, r.b) for r in pairs.collect()) == want


def test_band_join_meets_on_true_pairs_only(spark):
    # One busy person whose orders all precede the sends by a day: no pair, and none is compared.
    x = spark.range(3000).selectExpr("id AS a", "id % 1 AS person", "date_add(DATE'2026-01-08', CAST(id % 1 AS INT)) AS sent")
    y = spark.range(3000).selectExpr("id AS b", "id % 1 AS buyer", "date_add(DATE'2026-01-07', CAST(id % 1 AS INT)) AS placed")
    pairs = within_days(x, y, key=("person", "buyer"), day=("sent", "placed"), days=7, busy=500)
    assert pairs.count() == 0
    assert "CartesianProduct" not in plan(pairs) and "BroadcastNestedLoop" not in plan(pairs)


def test_band_join_refuses_equal_names(spark):
    x = spark.createDataFrame([(1, date(2026, 1, 1))], "k int, d date")
    with pytest.raises(ValueError, match="both sides have"):
        within_days(x, x, key=("k", "k"), day=("d", "d"), days=1)


# bitmap words


def test_words_count_distinct_keys_of_any_sign(spark):
    rng = random.Random(3)
    keys = [rng.choice([rng.randint(-500, 500), rng.randint(-(1 << 62), 1 << 62), -1, 0, None]) for _ in range(4000)]
    df = spark.createDataFrame([(k,) for k in keys], "key long").repartition(5)
    row = words(df).agg(
        F.sum(distinct_in(F.col("bits"))).alias("n"), F.sum("rows").alias("rows"), F.sum(F.when(F.col("word").isNull(), F.col("rows"))).alias("nulls")
    ).first()
    assert tuple(row) == (len(set(keys) - {None}), 4000, keys.count(None))


def test_dense_keys_hand_on_one_row_a_word(spark):
    partial = words(spark.range(0, 64_000, 1, 4).select(F.col("id").alias("key")))
    partial.collect()
    metrics = plan(partial)
    assert "partial_bit_or" in metrics and partial.count() == 1000


@pytest.mark.parametrize("starts", [[], [(3,)], [(1,), (1, 4), (3,), (3, 2), (3, 9), (6,)]])
def test_the_search_for_a_range_is_compiled_and_finds_what_the_column_does(spark, starts):
    from cartwright.operators.key_ranges import with_range

    rows = spark.range(200).select((F.col("id") % 9).alias("a"), (F.col("id") % 11).alias("b"))
    codes = [F.col("a"), F.col("b")]
    found = with_range(rows, codes, starts, "r")
    assert found.columns == ["a", "b", "r"]
    assert found.where(F.col("r") != range_of(codes, starts)).count() == 0
    assert "lambda" not in plan(found).split("== Physical Plan ==")[1]
    keyed = plan(dense_key(rows, ["a", "b"], "n", Scratch(spark)))
    assert "lambda" not in keyed


def test_a_tag_goes_on_only_where_the_order_leaves_columns_open(spark):
    rows = with_row_tag(spark.range(9000).selectExpr("id % 3 AS a", "id AS b"))
    written = []

    class Noted(Scratch):
        def stage(self, df, name):
            written.append(plan(df).split("== Physical Plan ==")[1])
            return super().stage(df, name)

    for order in (["a", "b"], ["a"]):
        keyed = dense_key(rows, order, "n", Noted(spark))
        assert keyed.where("n <= 3000").agg(F.max("a")).first()[0] == 0 and keyed.count() == 9000
    sorts = [next(x for x in p.splitlines() if "Sort [" in x) for p in written]
    assert ["_row_tag" in x for x in sorts] == [False, True]


def test_the_search_compares_the_bytes_of_texts(spark):
    rows = spark.range(9000).selectExpr(
        "CAST(id % 2 AS BIGINT) AS a", "IF(id % 50 = 0, NULL, concat('SKU-', id % 700, repeat('x', id % 3))) AS b", "id AS c"
    )
    ranges = Ranges(rows, [F.col("a"), F.col("b"), F.col("c")], 64)
    found = ranges.with_range(rows, "r")
    assert max(map(len, ranges.starts)) > 1 and found.columns == ["a", "b", "c", "r"]
    assert found.where(F.col("r") != ranges.of_row()).count() == 0
    # Numbers of a text are needed for the sketch only, and not for each row.
    text = plan(found).split("== Physical Plan ==")[1]
    assert "conv(" not in text and "lambda" not in text


def test_ranges_of_texts_that_differ_behind_all_steps_keep_their_order(spark):
    same = "x" * 40
    rows = spark.range(6000).selectExpr(f"IF(id % 10 = 0, 'a', concat('z{same}', IF(id % 2 = 0, 'b', 'aa'))) AS k")
    with settings(spark, shuffle__partitions="8"):
        keyed = dense_key(rows, ["k"], "n", Scratch(spark))
        wrong = keyed.withColumn("want", F.row_number().over(Window.orderBy("k", "n"))).where("n <> want")
        assert wrong.count() == 0


def test_numbers_are_found_by_words_as_by_a_plain_lookup(spark):
    from cartwright.operators import lookup_number

    def both(keys, wanted):
        orders = spark.createDataFrame([(k, f"t{i}") for i, k in enumerate(keys)], "id long, text string")
        numbered = dense_key(orders, ["id", "text"], "sk", Scratch(spark))
        rows = spark.createDataFrame([(k, i) for i, k in enumerate(wanted)], "id long, row int")
        found = lookup_number(rows, numbered, "id", "sk")
        wide = lookup(rows, numbered, "id", "id", {"sk": "sk"})
        assert found.schema == wide.schema and sorted(map(repr, found.collect())) == sorted(map(repr, wide.collect()))
        return "_bits" in found._jdf.queryExecution().optimizedPlan().toString()

    dense = [*range(-200, -50), *range(-64, 64, 3), *range(1 << 40, (1 << 40) + 300), None, None]
    wanted = [*range(-210, 200), *range((1 << 40) - 5, (1 << 40) + 310), None, 63, 64, -64, -65, 5]
    dense = [*dict.fromkeys(dense), None]
    assert both(dense, wanted)
    # Repeated keys repeat the rows, and sparse keys are no fewer words.
    assert not both([*dense, 5, 6, 6], wanted)
    assert not both([k * 100 for k in range(50)], range(0, 5000, 50))
    assert not both([], wanted)


def test_order_lines_and_payments_are_not_shuffled_to_their_orders(spark):
    from cartwright.operators import lookup_number

    numbered = dense_key(spark.range(500), ["id"], "sk", Scratch(spark), "bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = lookup_number(spark.range(900), numbered, "id", "sk")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
