"""Work that must not be done twice: payloads, log texts and aggregations."""

import json

from pyspark.sql import functions as F

from brookmart import schemas as S
from brookmart.operators import logs, metrics
from brookmart.plans import stats
from brookmart.queries import QUERIES
from brookmart.sources.topics import from_elements

RECORDS = [
    '{"common":{"mid":"1","uid":7},"page":{"page_id":"p","item":"9"},"displays":'
    '[{"item":"5","x":"{"},null,{}],"ts":1,"err":{"code":2}}',
    '{"displays":[{"item":"1","mid":"m","ts":5},{}]}',
    '{"common":{"is_new":"0"},"page":{"mid":"of page"},"displays":[{"mid":"m"}],"ts":2}',
    '{"common":{"mid":"3"},"start":{"entry":"icon"},"displays":[{"item":"1"}],"ts":3}',
    'no JSON',
]


def test_payloads_keep_every_field(spark):
    routed = logs.routed_payloads(logs.parse_log(from_elements(spark, RECORDS)))
    plan = routed._jdf.queryExecution().optimizedPlan().toString()
    # No map is made anew for each field that is tested against it.
    assert "array_contains(map_keys(map(" not in plan
    found = sorted((r.topic, json.dumps(json.loads(r.value), sort_keys=True))
                   for r in routed.collect())
    over = {"mid": "1", "uid": 7, "page_id": "p", "item": "9", "ts": 1}
    page = json.loads(RECORDS[0])
    wanted = [(S.DWD_PAGE, page), (S.DWD_DISPLAY, over | {"x": "{"}), (S.DWD_DISPLAY, over),
              (S.DWD_DISPLAY, {"item": "1", "mid": "m", "ts": None}), (S.DWD_DISPLAY, {"ts": None}),
              (S.DWD_PAGE, json.loads(RECORDS[2])),
              (S.DWD_DISPLAY, {"is_new": "0", "mid": "of page", "ts": 2}),
              (S.DWD_START, json.loads(RECORDS[3]))]
    assert found == sorted((t, json.dumps(v, sort_keys=True)) for t, v in wanted)


def test_routing_parses_what_it_needs(spark, sf_dir):
    plan = QUERIES["log_split_counts"](spark, sf_dir)._jdf.queryExecution().optimizedPlan()
    # Once where the test records are made, not again where they are routed.
    assert plan.toString().count("StructField(displays,") == 1
    source = from_elements(spark, RECORDS)
    some = logs.parse_log(source, fields=logs.ROUTED_FIELDS, raw=True)
    assert sorted(logs.routed_payloads(some).collect()) == sorted(
        logs.routed_payloads(logs.parse_log(source)).collect())


def test_seen_is_clicks_and_displays(spark):
    texts = [
        '{"page":{"item":"9","item_type":"sku_id"},"displays":[{"item":"5"},null],"ts":1}',
        '{"page":{"page_id":"p"},"displays":[{"item":"5","item_type":"sku_id"}],"ts":2}',
        '{"displays":[{"item":"6","item_type":"sku_id"}],"ts":3}',
        '{"page":{"item":"9","item_type":"sku_id"},"start":{"entry":"icon"},"ts":4}',
        '{"page":{"item":"9","item_type":"keyword"},"displays":[],"ts":5}']
    source = from_elements(spark, texts).withColumn("pos", F.lit(1))
    split = logs.split_log(logs.parse_log(source))
    apart = metrics.union_all([metrics.clicks(logs.page_views(split["page"])),
                               metrics.displays(logs.explode_displays(split["display"]))])
    one = metrics.seen(logs.parse_log(source, fields=metrics.SEEN_FIELDS))
    assert one.count() == apart.count() == 5
    assert one.exceptAll(apart).isEmpty() and apart.exceptAll(one).isEmpty()


def test_product_stats_work_is_done_once(spark, sf_dir):
    plan = QUERIES["product_stats"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    # Rows that cannot carry an id join those added up by id, after the first aggregation.
    assert plan.count("Union ") == 2 and plan.count("Aggregate ") == 2
    assert plan.count("Join Inner") == 1


def test_rows_without_ids_count_the_same(spark):
    m = spark.sql("""
        select * from values (1L, 0L, 5.0, 10L, true), (1L, 0L, 6.0, 10L, true),
            (1L, 0L, 1.0, 11L, true), (1L, 0L, 2.0, null, true), (1L, 3L, 0.0, null, false),
            (null, 4L, 0.0, null, false), (null, 1L, 0.0, null, false), (2L, 0L, 7.0, 10L, true)
        as t(sku_id, display_ct, order_amount, order_id, carries_id)""")
    rest = [c for c in (*metrics.PRODUCT_COUNTS, *metrics.PRODUCT_AMOUNTS) if c not in m.columns]
    m = m.select("*", *[F.lit(0).cast("bigint" if c in metrics.PRODUCT_COUNTS else S.MONEY)
                        .alias(c) for c in rest],
                 *[F.lit(None).cast("bigint").alias(c) for c in ("paid_order_id", "refund_order_id")],
                 F.lit(1000).cast("bigint").alias("ts")).withColumn(
                     "order_amount", F.col("order_amount").cast(S.MONEY))
    with_flag = stats.product_stats(m, stat_ts=F.lit(0)).drop("window")
    without = stats.product_stats(m.drop("carries_id"), stat_ts=F.lit(0)).drop("window")
    assert with_flag.schema == without.schema
    assert sorted(map(str, with_flag.collect())) == sorted(map(str, without.collect()))
    got = {r.sku_id: (r.display_ct, float(r.order_amount), r.order_ct)
           for r in with_flag.collect()}
    assert got == {1: (3, 14.0, 2), None: (5, 0.0, 0), 2: (0, 7.0, 1)}
