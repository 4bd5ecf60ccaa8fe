"""Hand-made inputs whose results follow from the rules."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmart import schemas as S
from brookmart.functions.keywords import explode_words, positive_counters, tokenize
from brookmart.functions.records import parse_typed
from brookmart.functions.times import age_in_years, duration_ms, yyyymmdd
from brookmart.operators import changelog as C
from brookmart.operators import enrich, firsts, logs, metrics, sequence, windows
from brookmart.operators.intervals import interval_join
from brookmart.plans import orders, serving, stats
from brookmart.sinks.tables import sink_projection, upsert_dim
from brookmart.sources.tables import read_dim
from brookmart.sources.topics import (TopicStore, from_elements, kafka_read_options,
                                      read_ods_log)


def rows(df, *columns):
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=str)


def views(spark, *records):
    return spark.createDataFrame(
        [(m, p, last, ts, i) for i, (m, p, last, ts) in enumerate(records)],
        "mid string, page_id string, last_page_id string, ts bigint, pos bigint")


def test_bounce_narrow(spark):
    pages = views(spark, ("101", "home", None, 10000), ("102", "home", "", 10000),
                  ("102", "good_list", "home", 14000), ("102", "good_list", "detail", 50000))
    assert rows(sequence.user_jump(pages, entry_breaks=False), "mid", "ts") == [("101", 10000)]


def test_bounce_full(spark):
    pages = views(spark, ("101", "home", None, 10000), ("101", "home", None, 11000),
                  ("102", "home", None, 10000), ("102", "good_list", "home", 16000),
                  ("102", "good_list", "detail", 50000))
    assert rows(sequence.user_jump(pages), "mid", "ts") == [
        ("101", 10000), ("101", 11000), ("102", 10000)]


def test_bounce_at_limit(spark):
    pages = views(spark, ("1", "a", None, 10000), ("1", "b", "a", 15000),
                  ("2", "a", None, 10000), ("2", "b", "a", 14999))
    assert rows(sequence.user_jump(pages), "mid") == [("1",)]


@pytest.mark.parametrize("bucket", ["5 seconds", "7 seconds", "10 minutes"])
def test_sequences_against_brute_force(spark, bucket):
    rng = random.Random(7)
    # One device makes a third of the views; times repeat and cross bucket edges.
    records = [("hot" if rng.random() < 0.34 else f"m{rng.randrange(40)}", "p",
                rng.choice([None, "home"]), rng.randrange(400) * 500) for _ in range(1500)]
    pages = views(spark, *records)
    entry = sequence.is_entry()
    matched, timed_out = sequence.followed_by(pages, entry, ~entry, "5 seconds", bucket=bucket)
    want_matched, want_late = set(), set()
    by_mid = {}
    for i, (m, _, last, ts) in enumerate(records):
        by_mid.setdefault(m, []).append((ts, i, last is None))
    for seen in by_mid.values():
        seen.sort()
        for one, two in zip(seen, [*seen[1:], None]):
            if one[2] and (two is None or two[0] - one[0] >= 5000):
                want_late.add(one[1])
            elif one[2] and not two[2]:
                want_matched.add((one[1], two[0]))
    assert {tuple(r) for r in matched.select("pos", "next_ts").collect()} == want_matched
    assert {r[0] for r in timed_out.select("pos").collect()} == want_late


def test_new_visitor(spark):
    pages = views(spark, ("1", "p", None, 12000), ("1", "p", None, 10500),
                  ("1", "p", None, 11000), ("1", "p", None, 71000), ("2", "p", None, 99000))
    flagged = firsts.flag_new_visitor(pages.withColumn("is_new", F.lit("1")))
    assert rows(flagged.where("is_new = '1'"), "mid", "ts") == [("1", 10500), ("2", 99000)]
    assert flagged.count() == 5


def test_new_visitor_ties_flag_one(spark):
    pages = views(spark, *[("1", "p", None, 10000)] * 5)
    assert firsts.flag_new_visitor(pages).where("is_new = '1'").count() == 1


def test_uv_midnight(spark):
    def ms(text):
        return int((datetime.fromisoformat(text) - datetime(1970, 1, 1)).total_seconds() * 1000)
    late, early = ms("2024-01-01 23:59:58"), ms("2024-01-02 00:00:01")
    pages = views(spark, *[("1", "p", None, t) for t in (late, late + 1, early, early + 1)])
    assert rows(firsts.daily_uv(pages), "ts") == [(late,), (early,)]


def test_hot_key_is_cut_before_the_shuffle(spark):
    pages = views(spark, *[("hot", "p", None, i) for i in range(50)])
    plan = firsts.daily_uv(pages)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex(
        "WindowGroupLimit")


def parsed(spark, *texts):
    return logs.parse_log(from_elements(spark, texts))


def test_display_merge(spark):
    one = parsed(spark, '{"common":{"mid":"1"},"page":{"page_id":"p","item":"9","item_type":"sku_id"},'
                        '"displays":[{"item":"5","item_type":"x"},{"item":"6"}],"ts":1}')
    assert rows(logs.explode_displays(one), "item", "item_type", "mid") == [
        ("9", "sku_id", "1")] * 2
    assert rows(logs.explode_displays(one, keep_display=True), "item") == [("5",), ("6",)]


def test_split(spark):
    records = parsed(spark,
                     '{"common":{"mid":"1"},"start":{"entry":"icon"},"page":{"page_id":"p"},"ts":1}',
                     '{"common":{"mid":"2"},"page":{"page_id":"p"},"displays":[{"item":"1"}],"ts":2}',
                     '{"common":{"mid":"3"},"displays":[{"item":"7","item_type":"sku_id"}],"ts":3}')
    split = logs.split_log(records)
    assert [rows(split[k], "ts") for k in ("start", "page", "display")] == [
        [(1,)], [(2,)], [(2,), (3,)]]
    assert rows(logs.explode_displays(split["display"]).where("ts = 3"), "item", "mid") == [
        ("7", "3")]
    routed = logs.routed_payloads(records)
    assert sorted(r.topic for r in routed.collect()) == [
        S.DWD_DISPLAY, S.DWD_DISPLAY, S.DWD_PAGE, S.DWD_START]


CHANGES = [
    '{"database":"shop","table":"t","type":"insert","ts":1,"xid":1,"data":{"id":1,"name":"a"}}',
    '{"database":"shop","table":"t","type":"bootstrap-insert","ts":2,"xid":2,"data":{"id":2,"name":"b"}}',
    '{"database":"shop","table":"t","type":"update","ts":3,"xid":3,"data":{"id":1,"name":"c"}}',
    '{"database":"shop","table":"t","type":"delete","ts":4,"data":{"id":1}}',
    '{"database":"shop","table":"t","type":"insert","ts":5,"data":{}}',
    '{"database":"shop","table":"t","type":"insert","ts":5}',
    '{"database":"other","table":"t","type":"insert","ts":6,"data":{"id":3}}',
    '{"database":"shop","table":"unknown","type":"insert","ts":7,"data":{"id":4}}',
    '{"database":"shop","type":"insert","ts":8,"data":{"id":4}}',
]


def config(spark, columns="id,name", sink="hbase", pk=None):
    return spark.createDataFrame(
        [("t", op, sink, "dim_t", columns, pk, None) for op in ("insert", "update")], S.CONFIG)


def test_changelog(spark):
    kept = C.changelog_etl(from_elements(spark, CHANGES))
    joined = C.join_config(kept, config(spark))
    assert rows(joined, "xid", "type") == [(1, "insert"), (2, "insert"), (3, "update")]


def test_prune_does_not_trim(spark):
    kept = C.changelog_etl(from_elements(spark, CHANGES[:1]))
    joined = C.join_config(kept, config(spark, "id, name"))
    assert rows(C.prune_columns(joined), "data") == [('{"id":1}',)]
    assert C.config_warnings(config(spark, "id, name")).count() == 2
    assert C.config_warnings(config(spark)).count() == 0


def test_config_latest(spark):
    changes = spark.createDataFrame(
        [("+I", "a", 1), ("-U", "a", 2), ("+U", "b", 3), ("-D", "b", 4)],
        "kind string, sink_table string, seq bigint"
    ).withColumn("source_table", F.lit("t")).withColumn("operate_type", F.lit("insert"))
    assert rows(C.latest_config(changes), "sink_table") == [("b",)]


@pytest.mark.parametrize("fold_every", [1, 2, 100])
def test_dim_upsert(spark, tmp_path, fold_every):
    root = str(tmp_path / "dims")
    joined = C.join_config(C.changelog_etl(from_elements(spark, CHANGES)), config(spark))
    upserts = C.dim_rows(C.route_by_sink(C.prune_columns(joined)))
    upsert_dim(upserts.where("xid < 3"), 0, root, fold_every)
    assert rows(read_dim(spark, root, "dim_t", ["id", "name"])) == [("1", "a"), ("2", "b")]
    for _ in range(2):  # a repeated batch changes nothing
        upsert_dim(upserts.where("xid = 3"), 1, root, fold_every)
    upsert_dim(upserts.where("xid = 1"), 2, root, fold_every)  # an older change comes late
    assert rows(read_dim(spark, root, "dim_t", ["id", "name", "no_such"])) == [
        ("1", "c", None), ("2", "b", None)]


def test_composite_key(spark):
    joined = C.join_config(C.changelog_etl(from_elements(spark, CHANGES)),
                           config(spark, pk="id,name"))
    upserts = C.dim_rows(C.route_by_sink(joined))
    assert C.latest_dim_rows(upserts).count() == 3


def timed(spark, prefix, *pairs):
    base = datetime(2024, 1, 1)
    return spark.createDataFrame([(k, base + timedelta(seconds=s)) for k, s in pairs],
                                 f"{prefix}k bigint, {prefix}t timestamp")


def test_interval_edge(spark):
    left = timed(spark, "l", (1, 0))
    right = timed(spark, "r", (1, -10), (1, 10), (1, -11), (1, 11), (1, 10.001), (2, 0))
    out = interval_join(left, right, ("lk", "rk"), ("lt", "rt"), "10 seconds", "10 seconds")
    assert [r.rt.second for r in out.orderBy("rt").collect()] == [50, 10]


def test_payment_edge(spark):
    left = timed(spark, "l", (1, 0))
    right = timed(spark, "r", (1, -2700), (1, -2701), (1, 5), (1, 6))
    out = interval_join(left, right, ("lk", "rk"), ("lt", "rt"),
                        orders.PAY_WINDOW, orders.PAY_SLACK)
    assert out.count() == 2


def test_interval_against_brute_force(spark):
    rng = random.Random(3)

    def some(n):  # key 0 holds a third on both sides
        return [(0 if rng.random() < 0.34 else rng.randrange(1, 20), rng.randrange(4000) / 4)
                for _ in range(n)]

    a, b = some(300), some(900)
    out = interval_join(timed(spark, "l", *a), timed(spark, "r", *b), ("lk", "rk"),
                        ("lt", "rt"), "3 seconds", "1 seconds")
    want = sum(1 for k, s in a for j, t in b if k == j and s - 3 <= t <= s + 1)
    assert out.count() == want > 0


def test_good_comment(spark):
    df = spark.createDataFrame([(i, f"120{i}", "2024-01-01 00:00:00") for i in range(1, 6)],
                               S.COMMENT_INFO)
    assert rows(metrics.comments(df).where("good_comment_ct = 1"), "sku_id") == [(4,), (5,)]


def test_unpivot_and_words(spark):
    df = spark.createDataFrame([(0, 2, 3)], "click_ct bigint, cart_ct bigint, order_ct bigint")
    assert rows(positive_counters(df, ["click_ct", "cart_ct", "order_ct"])) == [
        ("cart_ct", 2), ("order_ct", 3)]
    text = spark.createDataFrame([("Red red BOLT 5g 小米手机",), ("!!",), (None,)], "t string")
    assert {r.word for r in explode_words(text, "t").collect()} == {
        "red", "bolt", "5g", "小米手机"}

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def pairs(texts):
        return texts.map(lambda s: [s[i:i + 2] for i in range(0, len(s or ""), 2)])

    one = text.limit(1).select(F.array_sort(tokenize(F.lit("小米手机小米"), pairs)).alias("w"))
    assert one.first().w == ["小米", "手机"]


def test_late(spark):
    base = datetime(2024, 1, 1)
    hours = [(0, 0, 0), (1, 0, 1), (2, 0, 2), (3, 1, 2), (4, 1, 5)]    # id, sent, arrived
    df = spark.createDataFrame(
        [(i, base + timedelta(hours=a), base + timedelta(hours=b)) for i, a, b in hours]
        + [(5, base, None), (6, None, base)], "id int, sent timestamp, arrived timestamp")
    on_time, late = windows.split_late(df, "sent", "arrived", "1 hour", "1 hour")
    assert rows(late, "id") == [(2,), (4,)]
    assert rows(on_time, "id") == [(0,), (1,), (3,), (5,), (6,)]
    found = windows.lateness(df.where("sent is not null"), "sent", "arrived", "1 hour", "1 hour")
    assert rows(found, "on_time_ct", "late_ct", "last_behind_ms") == [
        (1, 1, 3 * 3_600_000), (3, 1, 3_600_000)]


def test_distinct_orders(spark):
    """An id repeated in a window counts once, and a hot product is no special case."""
    base = 1_704_067_200_000
    wide = [(7, o % 40, base + o % 3) for o in range(1000)] + [(8, 1, base), (8, None, base)]
    df = spark.createDataFrame(wide, "sku_id bigint, order_id bigint, ts bigint")
    m = df.select("sku_id", "ts", "order_id", *[F.lit(None).cast("bigint").alias(c) for c in (
        "paid_order_id", "refund_order_id")], *[F.lit(1).cast("bigint").alias(c)
                                                for c in metrics.PRODUCT_COUNTS],
                  *[F.lit(1).cast(S.MONEY).alias(c) for c in metrics.PRODUCT_AMOUNTS])
    out = stats.product_stats(m, stat_ts=F.lit(0))
    assert rows(out, "sku_id", "order_ct", "paid_order_ct", "click_ct") == [
        (7, 40, 0, 1000), (8, 1, 0, 2)]
    assert "window" in out.columns and "window" not in sink_projection(out).columns


def test_missing_stay_and_entry(spark):
    pages = spark.createDataFrame(
        [("v", "c", "a", "1", None, None, 1), ("v", "c", "a", "1", "home", 5, 2)],
        "vc string, ch string, ar string, is_new string, last_page_id string, "
        "during_time bigint, ts bigint")
    none = pages.where("false")
    out = stats.visitor_stats(metrics.visitor_metrics(pages, none, none), stat_ts=F.lit(9))
    assert rows(out, "stt", "edt", "pv_ct", "sv_ct", "uv_ct", "dur_sum", "ts") == [
        ("1970-01-01 00:00:00", "1970-01-01 00:00:05", 2, 1, 0, 5, 9)]


def test_missing_dimension(spark):
    facts = spark.createDataFrame([(1, 10), (2, 20)], "id bigint, sku_id bigint")
    dim = spark.createDataFrame([("10", "ring")], "id string, sku_name string")
    assert rows(enrich.lookup_dim(facts, dim, "sku_id", ["sku_name"])) == [(1, 10, "ring")]
    kept = enrich.enrich(facts, [enrich.DimSpec(dim, "sku_id", {"n": "sku_name"})], "left")
    assert rows(kept, "id", "n") == [(1, "ring"), (2, None)]
    assert rows(enrich.unmatched(facts, dim, "sku_id"), "id") == [(2,)]


def test_hot_product_join_is_split(spark):
    """A product with most of the lines is joined by several tasks."""
    facts = spark.range(60_000).select(
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("sku_id"),
        F.sha2(F.col("id").cast("string"), 512).alias("pad")).repartition(8)
    dim = spark.range(60_000).select(F.col("id").cast("string").alias("id"),
                                     F.lit("x").alias("sku_name"))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                           "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "200KB")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        out = enrich.lookup_dim(facts, dim, "sku_id", ["sku_name"])
        assert len(out.collect()) == 60_000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
        spark.conf.unset("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
        spark.conf.unset("spark.sql.adaptive.skewJoin.skewedPartitionFactor")


def test_serving(spark):
    table = spark.createDataFrame(
        [("2024-01-01 00:00:00", "b", "1.50"), ("2024-01-01 23:59:55", "a", "2.00"),
         ("2024-01-01 10:00:00", "b", "0.25"), ("2024-01-02 00:00:00", "a", "9.00")],
        "stt string, tm_name string, m string").select(
        "stt", "tm_name", F.col("m").cast(S.MONEY).alias("order_amount"))
    assert str(serving.gmv(table, 20240101).first()[0]) == "3.75"
    document = serving.brand_payload(serving.gmv_by_brand(table, 20240101)).first()[0]
    assert document == ('{"status":0,"msg":"","data":{"categories":["a","b"],'
                        '"series":[{"name":"商品品牌","data":[2.00,1.75]}]}}')


def test_small_functions(spark):
    one = spark.range(1)
    assert duration_ms("45 minutes") == 2_700_000
    assert one.select(yyyymmdd(F.lit("2022-03-16 14:13:59"))).first()[0] == 20220316
    age = age_in_years(F.lit("2000-01-01"), F.lit("2000-12-30").cast("date"))
    assert one.select(age).first()[0] == 0


def test_numbers_given_as_text(spark):
    records = from_elements(spark, [
        '{"sku_id":"7","order_id":8,"total_amount":"1.505","create_time":"x"}',
        '{"sku_id":"no","total_amount":2.5}', "not json"])
    out = parse_typed(records, S.REFUND_PAYMENT).drop("pos")
    assert [tuple(map(str, r)) for r in out.collect()] == [
        ("7", "8", "1.51", "x"), ("None", "None", "2.50", "None"), ("None",) * 4]


def test_log_files(spark, tmp_path):
    (tmp_path / "app.2024-01-01.log").write_text('{"ts":1}\n{"ts":1}\n')
    (tmp_path / "other.txt").write_text("no\n")
    lines = read_ods_log(spark, str(tmp_path))
    assert lines.count() == 2 and lines.select("pos").distinct().count() == 2


def test_kafka_options():
    options = kafka_read_options(TopicStore("kafka", "h:9092"), "t", "earliest")
    assert options["kafka.isolation.level"] == "read_committed"
    assert options["startingOffsets"] == "earliest" and options["subscribe"] == "t"
