from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cartwright.sources import landing, loads, profile
from cartwright.sources.entities import BY_KEY
from cartwright.sources.files import read_entity, read_text

SENDS = BY_KEY["marketing/email_sends"]
ORDERS = BY_KEY["postgres/orders"]
PAYMENTS = BY_KEY["payments/transactions"]
ITEMS = BY_KEY["postgres/order_items"]


def write(path, text):
    path.write_text(text)
    return str(path)


ITEM_HEADER = ",".join(f.name for f in ITEMS.schema) + "\n"


def test_csv_missing_texts_and_numbers(spark, tmp_path):
    path = write(
        tmp_path / "items.csv",
        ITEM_HEADER + "1,10,NA,NULL,None,2.0,1.50,,3.00\n2,10,5,S,\"A, b\",3,1.50,0.00,4.50\n",
    )
    first, second = read_entity(spark, ITEMS, path).orderBy("order_item_id").collect()
    assert (first.product_id, first.sku, first.product_name) == (None, None, None)
    assert (first.quantity, first.discount_amount) == (2, None)
    assert second.product_name == "A, b"


def test_csv_bad_number_fails(spark, tmp_path):
    path = write(tmp_path / "items.csv", ITEM_HEADER + "x1,10,1,S,P,2,1.50,0,3.00\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|x1"):
        read_entity(spark, ITEMS, path).collect()


def test_times_with_and_without_zone(spark, tmp_path):
    header = ",".join(f.name for f in ORDERS.schema) + "\n"
    row = "{},1,{},new,USD,1,0,0,0,1,paid,1,1,2026-03-10\n"
    path = write(
        tmp_path / "orders.csv",
        header + row.format(1, "2026-03-10T09:00:00Z") + row.format(2, "2026-03-10 09:00:00")
        + row.format(3, "2026-03-10T11:00:00+02:00"),
    )
    df = read_entity(spark, ORDERS, path)
    assert {r.order_date for r in df.collect()} == {datetime(2026, 3, 10, 9)}
    assert df.first().updated_at == datetime(2026, 3, 10)


def test_json_lines_equal_json_array(spark, tmp_path):
    one = (
        '{"transaction_id": "t1", "order_id": 5, "gross_amount": 1.50,'
        ' "refund_flag": true, "card_brand": null}'
    )
    lines = write(tmp_path / "a.jsonl", one + "\n")
    array = write(tmp_path / "b.json", "[" + one + "]")
    a = read_entity(spark, PAYMENTS, lines, json_lines=True).collect()
    assert a == read_entity(spark, PAYMENTS, array).collect()
    assert (a[0].order_id, a[0].refund_flag, a[0].card_brand) == (5, True, None)


def test_a_flat_json_array_is_read_without_going_back_for_its_numbers(spark, tmp_path):
    rows = (
        '[{"transaction_id": "say \\"1\\", 2.50 {[", "order_id": 5, "gross_amount": 1234567890123456.70, "voucher": 12.30},\n'
        ' {"transaction_id": "-7", "order_id": -6, "gross_amount": 1e2, "refund_flag": false, "voucher": "x: 1"}, {"voucher": null}]'
    )
    texts = read_text(spark, PAYMENTS, write(tmp_path / "a.json", rows))
    assert "FileScan json" not in texts._jdf.queryExecution().toString()
    found = [(r.transaction_id, r.order_id, r.gross_amount, r.refund_flag, r.voucher) for r in texts.collect()]
    assert found == [
        ('say "1", 2.50 {[', "5", "1234567890123456.70", None, "12.30"), ("-7", "-6", "1e2", "false", "x: 1"), (None,) * 5
    ]
    # One object, nested values and other quotes are read as before.
    for text, voucher in (('{"voucher": 1.0}', "1.0"), ('[{"voucher": {"a": 1.50}}]', '{"a": 1.50}'), ("[{'voucher': 'a \"1'}]", 'a "1')):
        assert [r.voucher for r in read_text(spark, PAYMENTS, write(tmp_path / "b.json", text)).collect()] == [voucher]
    for broken in ('[{"order_id": 01}]', '[{"order_id": 1.}]', '[{"order_id": 5]'):
        with pytest.raises(Exception, match="(?i)malformed"):
            read_text(spark, PAYMENTS, write(tmp_path / "c.json", broken)).collect()


def test_pages_of_an_array_do_not_grow_with_a_key(spark, tmp_path, monkeypatch):
    from cartwright.registry import queries

    orders = spark.sql(
        "SELECT 7L AS o_orderkey, id AS o_custkey, 'F' AS o_orderstatus, 10.25D AS o_totalprice,"
        " TIMESTAMP_NTZ'2024-01-01 00:00:00' AS o_orderdate, '5-LOW' AS o_orderpriority FROM range(100)"
    )
    orders.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(queries, "ROWS_OF_A_PAGE", 10, raising=False)
    read = queries.json_array_typed(spark, str(tmp_path))
    assert read.count() == 100 and len(read.inputFiles()) == 10


def sends(spark, rows):
    base = spark.createDataFrame(rows, "send_date date, campaign_id string, customer_id long")
    return base.select(
        *[F.col(f.name) if f.name in base.columns else F.lit(None).cast(f.dataType).alias(f.name)
          for f in SENDS.schema]
    )


def test_landing_replaces_one_day_and_refuses_nothing(spark, tmp_path):
    root = str(tmp_path)
    first = sends(spark, [(date(2026, 3, 1), "a", 1), (date(2026, 3, 1), "b", 2)])
    assert landing.land(first, root, SENDS, "2026-03-01") == 2
    assert landing.land(first, root, SENDS, "2026-03-02") == 2
    again = sends(spark, [(date(2026, 3, 1), "c", 3)])
    assert landing.land(again, root, SENDS, "2026-03-01") == 1
    counts = landing.read_landed(spark, root, SENDS).groupBy("dt").count().collect()
    assert {r.dt: r["count"] for r in counts} == {"2026-03-01": 1, "2026-03-02": 2}
    with pytest.raises(landing.EmptyExtractError):
        landing.land(again.where("customer_id > 9"), root, SENDS, "2026-03-01")
    assert landing.read_partition(spark, root, SENDS, "2026-03-01").count() == 1


def test_partition_read_prunes_other_days(spark, tmp_path):
    rows = [(date(2026, 3, d), "a", d) for d in range(1, 6)]
    landing.land_days(sends(spark, rows), str(tmp_path), SENDS, F.col("send_date"))
    day = landing.read_partition(spark, str(tmp_path), SENDS, "2026-03-03").select("customer_id")
    assert [r[0] for r in day.collect()] == [3]
    text = day._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(dt" in text and "ReadSchema: struct<customer_id:bigint>" in text


def test_a_failed_entity_does_not_stop_the_others(spark, sample_files, tmp_path):
    files = {
        "postgres/orders": str(tmp_path / "nowhere.csv"),
        "postgres/products": sample_files["postgres/products"],
    }
    log = {r.entity: r for r in loads.ingest(spark, files, str(tmp_path), "2026-03-10").collect()}
    assert log["orders"].status == "failed" and log["orders"].error_message
    assert (log["products"].status, log["products"].rows_ingested) == ("success", 5)
    with pytest.raises(KeyError):
        loads.ingest(spark, {"ftp/orders": "x"}, str(tmp_path), "2026-03-10")
    with pytest.raises(ValueError):
        loads.ingest(spark, files, str(tmp_path), "10.03.2026")


def test_fingerprints_of_the_sample_day(sample_day):
    hashes = {r.entity: r.schema_hash for r in sample_day[1].collect()}
    assert hashes["orders"] == "14a5704b301a2efb"
    assert hashes["customers"] == "c6b5d4b070c54cf6"


def test_drift_between_loads(spark, sample_files, tmp_path):
    header = ",".join(f.name for f in ITEMS.schema) + "\n"
    blank = write(tmp_path / "items.csv", header + "1,201,,LAMP-A,Desk Lamp,1,1.00,0.00,1.00\n")
    key = "postgres/order_items"
    for run, path in (("r1", sample_files[key]), ("r2", sample_files[key]), ("r3", blank)):
        loads.append_log(
            loads.ingest(spark, {key: path}, str(tmp_path), "2026-03-10", run), str(tmp_path)
        )
    log = spark.read.parquet(f"{tmp_path}/ingestion_log")
    drifted = {r.run_id: r.drifted for r in loads.log_drift(log).collect()}
    assert drifted == {"r1": False, "r2": False, "r3": True}


def dtypes(spark, values, **options):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return profile.with_dtype(profile.column_profile(df), **options).first().dtype


def test_implied_types(spark):
    assert dtypes(spark, ["1", "2"]) == "int64"
    assert dtypes(spark, ["1", None]) == "float64"
    assert dtypes(spark, ["1.5", "2"]) == "float64"
    assert dtypes(spark, [None, None]) == "float64"
    assert dtypes(spark, ["true", "False"]) == "bool"
    assert dtypes(spark, ["true", None]) == "object"
    assert dtypes(spark, ["a", "1"]) == "object"
    assert dtypes(spark, ["1", "2"], texts=["v"]) == "object"
    assert dtypes(spark, ["2026-03-10", None], dates=["v"]) == "datetime64[ns]"
    assert dtypes(spark, ["2026-03-10T09:00:00Z"], dates=["v"]) == "datetime64[ns, UTC]"


def test_drift_is_flagged_where_a_type_changes(spark):
    rows = [("d1", "1"), ("d2", "2"), ("d3", "x"), ("d4", "y"), ("d5", None)]
    df = spark.createDataFrame(rows, "dt string, v string")
    prints = profile.fingerprint(profile.with_dtype(profile.column_profile(df, ["dt"])), ["dt"])
    flags = profile.drift(prints.withColumn("entity", F.lit("e"))).orderBy("dt").collect()
    assert [r.drifted for r in flags] == [False, False, True, False, True]


def test_every_reason_of_a_bad_request_is_listed(spark):
    requests = spark.createDataFrame(
        [
            (1, "postgres", "orders", "2026-03-10"),
            (2, "postgres", " ", "2026-02-30"),
            (3, "ftp", "orders", None),
            (4, "payments", "orders", "2026-3-1"),
        ],
        "id int, source string, entity string, partition_date string",
    )
    rejected = loads.rejected_requests(requests, loads.known_entities(spark)).collect()
    assert sorted((r.id, r.reason) for r in rejected) == [
        (2, "bad date"),
        (2, "blank entity"),
        (3, "bad date"),
        (3, "unknown source"),
        (4, "bad date"),
        (4, "unknown entity"),
    ]


def test_a_day_counts_as_a_whole_text(spark, tmp_path):
    header = ",".join(f.name for f in SENDS.schema) + "\n"
    row = "{},m,n,e,1,delivered,true,true,false,f,2026-03-11T01:12:00Z\n"

    def days(*texts):
        path = write(tmp_path / f"s{abs(hash(texts))}.csv", header + "".join(map(row.format, texts)))
        return [r.send_date for r in read_entity(spark, SENDS, path).collect()]

    assert days("2026-03-14", "2026-03-14T23:30:00-05:00", "2026-03-14 23:30:00", "2026-03-14T01:00:00+02:00") == [
        date(2026, 3, 14),
        date(2026, 3, 15),
        date(2026, 3, 14),
        date(2026, 3, 13),
    ]
    for junk in ("2026-03-141junk", "2026-03-14junk", "2026-3-14x", "2026-02-30"):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT|DATETIME|invalid"):
            days(junk)


def test_day_does_not_depend_on_the_session_zone(spark, tmp_path):
    header = ",".join(f.name for f in SENDS.schema) + "\n"
    path = write(tmp_path / "s.csv", header + "2026-03-14T23:30:00-05:00,m,n,e,1,d,true,true,false,f,2026-03-11T01:12:00Z\n")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert read_entity(spark, SENDS, path).first().send_date == date(2026, 3, 15)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_dates_with_a_junk_tail_are_text(spark):
    assert dtypes(spark, ["2026-03-14junk"], dates=["v"]) == "object"
    assert dtypes(spark, ["2026-03-141"], dates=["v"]) == "object"
    assert dtypes(spark, ["2026-02-30"], dates=["v"]) == "object"
    assert dtypes(spark, ["2026-03-14 10:00", "2026-03-14T10:00:00.5"], dates=["v"]) == "datetime64[ns]"


def test_one_blank_is_a_text(spark, tmp_path):
    path = write(tmp_path / "items.csv", ITEM_HEADER + "1,10,5, ,P,1,1.50,0,1.50\n")
    assert read_entity(spark, ITEMS, path).first().sku == " "


def test_unregistered_columns_are_landed_as_text(spark, tmp_path):
    path = write(tmp_path / "items.csv", ITEM_HEADER.strip() + ",gift note\n1,10,5,S,P,1,1.50,0,1.50,for you\n")
    df = read_entity(spark, ITEMS, path)
    assert df.columns[-1] == "gift note" and df.first()["gift note"] == "for you"
    root = str(tmp_path / "land")
    assert landing.land(df, root, ITEMS, "2026-03-14") == 1
    landed = spark.read.parquet(landing.entity_path(root, ITEMS))
    assert landed.first()["gift note"] == "for you"


def test_new_json_keys_are_landed_and_change_the_fingerprint(spark, tmp_path):
    lines = ['{"transaction_id": "t%d", "order_id": %d}' % (i, i) for i in range(50)]
    old = write(tmp_path / "old.jsonl", "\n".join(lines))
    new = write(tmp_path / "new.jsonl", "\n".join([*lines, '{"transaction_id": "t99", "brand_new": {"a": 1}}']))
    before, after = (read_entity(spark, PAYMENTS, p, json_lines=True) for p in (old, new))
    assert after.columns == [*before.columns, "brand_new"]
    assert after.where("transaction_id = 't99'").first()["brand_new"] == '{"a": 1}'
    prints = [
        loads.entity_fingerprint(loads.read_text(spark, PAYMENTS, p, True), "payments/transactions").first()
        for p in (old, new)
    ]
    assert prints[0].schema_hash != prints[1].schema_hash
    assert prints[1].schema_columns.endswith(",brand_new")


def test_line_ends_inside_quotes(spark, tmp_path):
    path = write(tmp_path / "items.csv", ITEM_HEADER + '1,10,5,S,"two\nlines",1,1.50,0,1.50\n2,10,5,S,P,1,1.50,0,1.50\n')
    df = read_entity(spark, ITEMS, path, multi_line=True)
    assert [r.product_name for r in df.orderBy("order_item_id").collect()] == ["two\nlines", "P"]


def test_unset_scratch_root_is_under_the_warehouse():
    from types import SimpleNamespace as Fake

    from cartwright.sources.scratch import scratch_root

    def session(**conf):
        context = Fake(getCheckpointDir=lambda: Fake(isDefined=lambda: False))
        settings = {f"spark.{k.replace('_', '.')}": v for k, v in conf.items()}
        return Fake(conf=Fake(get=settings.get), sparkContext=Fake(_jsc=Fake(sc=lambda: context)))

    assert scratch_root(session(sql_warehouse_dir="s3a://lake/wh/")) == "s3a://lake/wh/_scratch"
    assert scratch_root(session(sql_warehouse_dir="w", checkpoint_dir="hdfs://x")) == "hdfs://x"
    with pytest.raises(ValueError):
        scratch_root(session())


def test_columns_that_only_some_days_have_are_read_back(spark, tmp_path):
    root = str(tmp_path)
    rows = sends(spark, [(date(2026, 3, 1), "a", 1), (date(2026, 3, 1), "b", 2)])
    landing.land(rows, root, SENDS, "2026-03-01")
    landing.land(rows.withColumn("batch note", F.col("campaign_id")), root, SENDS, "2026-03-02")
    landing.land(rows.withColumn("other", F.lit("o")), root, SENDS, "2026-03-03")
    known = [f.name for f in SENDS.schema]
    assert landing.read_partition(spark, root, SENDS, "2026-03-01").columns == known
    second = landing.read_partition(spark, root, SENDS, "2026-03-02")
    assert second.columns == [*known, "batch note"]
    assert sorted(r["batch note"] for r in second.collect()) == ["a", "b"]
    every = landing.read_landed(spark, root, SENDS)
    assert set(every.columns) == {*known, "batch note", "other", "dt"} and every.count() == 6
    some = landing.read_landed(spark, root, SENDS, others=["other"])
    assert some.columns == [*known, "other", "dt"]
    assert {r.dt for r in some.where("other = 'o'").collect()} == {"2026-03-03"}
    bronze = landing.bronze(spark, root, [SENDS], "2026-03-02")[SENDS.table]
    assert "batch note" in bronze.columns


def test_logged_columns_say_what_was_landed(spark, tmp_path):
    header = ",".join(f.name for f in ITEMS.schema)
    plain = write(tmp_path / "a.csv", header + "\n1,201,5,LAMP-A,Desk Lamp,1,1.00,0.00,1.00\n")
    more = write(tmp_path / "b.csv", header + ",gift wrap\n1,201,5,LAMP-A,Desk Lamp,1,1.00,0.00,1.00,red\n")
    root, key = str(tmp_path / "raw"), "postgres/order_items"
    log = loads.ingest(spark, {key: plain}, root, "2026-03-10", "r1").unionByName(
        loads.ingest(spark, {key: more}, root, "2026-03-11", "r2")
    )
    assert loads.other_columns(log, ITEMS) == ["gift wrap"]
    assert loads.other_columns(log.where("run_id = 'r1'"), ITEMS) == []
    landed = landing.read_landed(spark, root, ITEMS, others=loads.other_columns(log, ITEMS))
    assert {(r.dt, r["gift wrap"]) for r in landed.collect()} == {("2026-03-10", None), ("2026-03-11", "red")}


def test_a_load_evaluates_its_extract_once(spark, tmp_path, monkeypatch):
    counter = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        counter.add(1)
        return value

    read = loads.read_text
    monkeypatch.setattr(loads, "read_text", lambda *a: read(*a).withColumn("sku", counted("sku")))
    header = ",".join(f.name for f in ITEMS.schema)
    rows = "".join(f"{i},201,5,LAMP-A,Desk Lamp,1,1.00,0.00,1.00\n" for i in range(50))
    path = write(tmp_path / "a.csv", header + "\n" + rows)
    log = loads.ingest(spark, {"postgres/order_items": path}, str(tmp_path / "raw"), "2026-03-10").first()
    assert (log.status, log.rows_ingested, counter.value) == ("success", 50, 50)
    assert log.schema_hash == loads.entity_fingerprint(read(spark, ITEMS, path), "postgres/order_items").first().schema_hash


def test_an_empty_or_failing_load_leaves_the_day(spark, tmp_path):
    header = ",".join(f.name for f in ITEMS.schema)
    good = write(tmp_path / "a.csv", header + "\n1,201,5,LAMP-A,Desk Lamp,1,1.00,0.00,1.00\n")
    empty = write(tmp_path / "b.csv", header + "\n")
    broken = write(tmp_path / "c.csv", header + "\n1,x1,5,LAMP-A,Desk Lamp,1,1.00,0.00,1.00\n")
    root, key = str(tmp_path / "raw"), "postgres/order_items"
    for path, status in ((good, "success"), (empty, "failed"), (broken, "failed")):
        log = loads.ingest(spark, {key: path}, root, "2026-03-10").first()
        assert log.status == status
        assert landing.read_partition(spark, root, ITEMS, "2026-03-10").count() == 1
    assert "EmptyExtractError" in loads.ingest(spark, {key: empty}, root, "2026-03-10").first().error_message


def test_measures_are_the_profile(spark):
    df = spark.createDataFrame([("1", "a", None), ("2", "", "2026-03-10"), (None, "true", "x")], "n string, t string, `d d` string")
    counted = df.agg(*profile.measures(df.columns)).first().asDict()
    one = sorted(map(tuple, profile.from_measures(spark, df.columns, counted).collect()))
    two = profile.column_profile(df)
    assert one == sorted(map(tuple, two.select(profile.from_measures(spark, df.columns, counted).columns).collect()))
    assert profile.column_profile(df.limit(0)).count() == 0


def test_type_patterns_are_asked_last_and_decide_alike(spark):
    texts = [None, "", " ", "1", " 12\t", "+7", "-0", "1.", ".5", "1e5", "1.5E-3 ", "inf", "Infinity", "-inf", "Inf", "İnf", "i", "x1", "12x",
             "9" * 18, "9" * 19, "-" + "9" * 19, " 9223372036854775807\n", "true", "FALSE", " true", "truE\n", "tru", "2024-02-30", "2024-02-29",
             "2024-02-29 10:11", "2024-02-29T10:11:12.5Z", "2024-02-29T10:11-05:00\n", " 2024-02-29", "at 10:11+0100", "12:3Z", "10:é1Z", "٣", ":", ";"]
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    long_int = "(v RLIKE r'^\\s*[+-]?\\d{19,}\\s*$' AND try_cast(v AS bigint) IS NOT NULL)"
    plain = {
        "non_null": F.col("v").isNotNull(),
        "int_like": F.col("v").rlike(profile._SHORT_INT) | F.expr(long_int),
        "double_like": F.col("v").rlike(profile._DOUBLE),
        "bool_like": F.lower("v").isin("true", "false"),
        "date_like": F.col("v").rlike(profile._DATE) & F.col("v").try_cast("timestamp").isNotNull(),
        "zoned": F.col("v").rlike(r"\d:\d.*(Z|[+-]\d{2}:?\d{2})$"),
    }
    tests = profile._tests(F.col("v"))
    assert list(tests) == list(plain)
    both = [F.coalesce(side[n], F.lit(False)).alias(f"{n}{i}") for n in plain for i, side in enumerate((tests, plain))]
    for row in rows.select("v", *both).collect():
        for n in plain:
            assert row[f"{n}0"] == row[f"{n}1"], (n, row["v"])
    for n, test in tests.items():
        before, pattern, _ = str(test).removeprefix("Column<'").lower().partition("rlike")
        assert not pattern or "<" in before or "contains" in before, n


def test_measures_of_a_wide_extract_are_counted_in_several_steps(spark, tmp_path):
    df = spark.range(7).select(*[F.col("id").cast("string").alias(f"c{i}") for i in range(9)])
    rows, seen = profile.observed(df)
    rows.write.parquet(f"{tmp_path}/rows")
    found = {name: n for part in seen for name, n in part.get.items()}
    assert len(seen) > 1 and max(len(part.get) for part in seen) <= profile._AT_ONCE
    assert found == df.agg(*profile.measures(df.columns)).first().asDict()
