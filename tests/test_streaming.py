"""Batch and streaming forms give the same rows; restarts add nothing.

A stream emits what its watermark has passed, so each input ends in a far-future record
whose own result is left out of the comparison.
"""

import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from brookmart import adapters as A
from brookmart import schemas as S
from brookmart.functions.records import to_payload
from brookmart.operators import changelog as C
from brookmart.operators import firsts, logs, metrics, sequence
from brookmart.plans import orders, stats
from brookmart.sources.tables import read_dim
from brookmart.sinks.tables import compact_day, upsert_dim
from brookmart.sinks.topics import show_stream
from brookmart.sources.topics import TopicStore, read_topic, read_topics, topic_table
from brookmart.streaming import jobs, stateful

SENTINEL = 4_102_444_800_000  # 2100-01-01
GAP = "6 hours"


@pytest.fixture
def site(spark, tmp_path):
    topics = TopicStore("files", str(tmp_path / "topics"), jobs.SHARED)
    return jobs.Site(spark, topics, str(tmp_path / "tables"), str(tmp_path / "checkpoints"),
                     trigger=None)


def put(site, topic, texts, name="part-0"):
    """Write text lines as one file of a topic."""
    folder = site.topics.folder(topic)
    if topic in site.topics.shared:
        folder += f"/topic={topic}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.txt", "w", encoding="utf-8") as out:
        out.writelines(t + "\n" for t in texts)


def texts_of(df):
    return [r[0] for r in df.select("value").collect()]


def rows(df, *columns):
    columns = columns or df.columns
    return sorted((tuple(r) for r in df.select(*columns).collect()),
                  key=lambda r: [(v is None, v) for v in r])


def stream_rows(spark, df, name, *columns, mode="append"):
    query = (df.writeStream.format("memory").queryName(name).outputMode(mode)
               .trigger(availableNow=True).start())
    query.awaitTermination(120)
    assert query.exception() is None
    return rows(spark.table(name), *columns)


def log_text(mid, ts, page="home", last=None):
    tail = f',"last_page_id":"{last}"' if last else ""
    return (f'{{"common":{{"mid":"{mid}","vc":"v","ch":"c","ar":"a","is_new":"1"}},'
            f'"page":{{"page_id":"{page}"{tail},"during_time":10}},"ts":{ts}}}')


@pytest.fixture
def page_stream(spark, sf_dir, site):
    """(batch, stream) of flat page rows; positions are hashes in both."""
    put(site, S.ODS_LOG, [*texts_of(A.log_topic(spark, sf_dir)), log_text("end", SENTINEL)])

    def flat(df):
        return logs.page_views(logs.parse_log(df))

    batch = A.log_topic(spark, sf_dir).select("value", F.xxhash64("value").alias("pos"))
    return flat(batch), flat(read_topic(spark, S.ODS_LOG, site.topics))


def test_new_visitor_stream(spark, page_stream):
    batch, stream = page_stream
    got = stream_rows(spark, stateful.flag_new_visitor_stream(stream), "nv", "mid", "pos", "is_new")
    want = rows(firsts.flag_new_visitor(batch), "mid", "pos", "is_new")
    assert [g for g in got if g[0] != "end"] == want
    assert sum(w[2] == "1" for w in want) == batch.select("mid").distinct().count()


def test_daily_uv_stream(spark, page_stream):
    batch, stream = page_stream
    got = stream_rows(spark, stateful.daily_uv_stream(stream), "uv", "mid", "pos")
    assert [g for g in got if g[0] != "end"] == rows(firsts.daily_uv(batch), "mid", "pos")


@pytest.mark.parametrize("entry_breaks", [True, False])
def test_user_jump_stream(spark, page_stream, entry_breaks):
    batch, stream = page_stream
    jumps = stateful.user_jump_stream(stream, GAP, entry_breaks)
    got = stream_rows(spark, jumps, f"uj{entry_breaks}", "mid", "pos")
    want = rows(sequence.user_jump(batch, GAP, entry_breaks), "mid", "pos")
    assert [g for g in got if g[0] != "end"] == want


def test_sequence_fixture_stream(spark, site):
    put(site, S.ODS_LOG, [log_text("101", 10000), log_text("101", 11000), log_text("102", 10000),
                          log_text("102", 16000, "good_list", "home"),
                          log_text("102", 50000, "good_list", "detail"),
                          log_text("end", SENTINEL)])
    stream = logs.page_views(logs.parse_log(read_topic(spark, S.ODS_LOG, site.topics)))
    got = stream_rows(spark, stateful.user_jump_stream(stream), "ujfix", "mid", "ts")
    assert got == [("101", 10000), ("101", 11000), ("102", 10000)]


def stream_of(spark, site, texts, name="part-0"):
    put(site, S.ODS_LOG, texts, name)
    return logs.page_views(logs.parse_log(read_topic(spark, S.ODS_LOG, site.topics)))


def test_no_record_reaches_python(spark, page_stream):
    """Sequences have no Python in their plan; first records give it times and positions only."""
    _, stream = page_stream

    def plan(df, name):
        query = (df.writeStream.format("memory").queryName(name).trigger(availableNow=True).start())
        query.awaitTermination(120)
        return query._jsq.explainInternal(False), query.lastProgress

    text, _ = plan(stateful.user_jump_stream(stream, GAP), "plan_uj")
    assert "Python" not in text and "TransformWithState" not in text
    for name, df in (("nv", stateful.flag_new_visitor_stream(stream)),
                     ("uv", stateful.daily_uv_stream(stream))):
        text, _ = plan(df, f"plan_{name}")
        below = text[text.index("TransformWithState"):]
        arguments = below.splitlines()[0]
        assert "page_id" not in arguments and "during_time" not in arguments


@pytest.mark.parametrize("parts", [1, 4, 7])
def test_a_busy_device_among_others(spark, site, parts):
    """A device with a third of all records, times that tie, steps exactly at the limit."""
    rng = random.Random(parts)
    texts = list(dict.fromkeys(
        log_text("busy" if i % 3 == 0 else f"d{i % 40}", 250 * rng.randrange(800),
                 rng.choice("ab"), rng.choice([None, "x"])) for i in range(600)))
    stream = stream_of(spark, site, [*texts, log_text("end", SENTINEL)])
    batch = logs.page_views(logs.parse_log(spark.createDataFrame(
        [(t,) for t in texts], "value string").withColumn(
            "pos", F.xxhash64("value"))))
    entry, other = sequence.is_entry("last_page_id"), F.col("page_id") == "b"
    got = stream_rows(spark, stateful.match_next_stream(stream, entry, other, "2 seconds",
                                                        parts=parts),
                      f"busy{parts}", "mid", "ts", "outcome", "next_ts")
    want = rows(sequence.match_next(batch, entry, other, "2 seconds"),
                "mid", "ts", "outcome", "next_ts")
    assert [g for g in got if g[0] != "end"] == want and want


def test_visitor_state_of_old_days_goes(spark, site):
    """Over three days the state never holds more devices than the last day has."""
    day = 86_400_000
    wanted = [*sorted((f"a{i}", 1000 + i) for i in range(20)), ("b", 3 * day)]
    stream = stream_of(spark, site, [log_text(m, t) for m, t in wanted[:-1]], "part-0")
    query = (stateful.daily_uv_stream(stream).writeStream.format("memory").queryName("uv_days")
             .option("checkpointLocation", site.checkpoint("uv_days")).start())
    try:
        query.processAllAvailable()
        put(site, S.ODS_LOG, [log_text("b", 3 * day), log_text("b", 3 * day + 1)], "part-1")
        query.processAllAvailable()
        put(site, S.ODS_LOG, [log_text("c", 6 * day)], "part-2")
        query.processAllAvailable()
        for _ in range(120):        # the batch without data that follows
            if rows(spark.table("uv_days"), "mid", "ts") == wanted:
                break
            time.sleep(0.5)
        time.sleep(1)
        assert rows(spark.table("uv_days"), "mid", "ts") == wanted
        state = [s["numRowsTotal"] for s in query.lastProgress["stateOperators"]]
        assert state and max(state) <= 8, state
    finally:
        query.stop()


def test_days_of_a_zone(spark, site):
    """Two records around midnight in Shanghai are two days there and one in UTC."""
    before, after = 1_704_124_799_000, 1_704_124_801_000      # 15:59:59 and 16:00:01 UTC
    stream = stream_of(spark, site, [log_text("1", before), log_text("1", after),
                                     log_text("end", SENTINEL)])
    for zone, want in ((None, [before]), ("Asia/Shanghai", [before, after])):
        got = stream_rows(spark, stateful.daily_uv_stream(stream, zone=zone),
                          f"zone_{'utc' if zone is None else 'other'}", "mid", "ts")
        assert [g[1] for g in got if g[0] == "1"] == want
        batch = logs.page_views(logs.parse_log(spark.read.text(
            site.topics.folder(S.ODS_LOG)).withColumn("pos", F.xxhash64("value"))))
        assert rows(firsts.daily_uv(batch, zone=zone).where("mid = '1'"), "ts") == [
            (t,) for t in want]


def order_site(spark, sf_dir, site):
    late = '"create_time":"2100-01-01 00:00:00"'
    put(site, S.DWD_ORDER_INFO, [*texts_of(to_payload(A.order_info(spark, sf_dir))),
                                 '{"id":-1,' + late + "}"])
    put(site, S.DWD_ORDER_DETAIL, [*texts_of(to_payload(A.order_detail(spark, sf_dir))),
                                   '{"id":-1,"order_id":-1,' + late + "}"])
    put(site, S.DWD_PAYMENT_INFO, [*texts_of(to_payload(A.payment_info(spark, sf_dir))),
                                   '{"id":-1,"order_id":-1,' + late + "}"])


def test_order_chain(spark, sf_dir, site):
    """Orders to order wide, payment wide, and region statistics, through topics."""
    order_site(spark, sf_dir, site)
    dims, as_of = A.dims(spark, sf_dir), F.lit("2024-01-31").cast("date")
    slack = "30 days"
    # Rows of one file arrive in any order of time: nothing may count as late.
    jobs.order_wide_job(site, dims, as_of, slack, slack, "4000 days").awaitTermination(180)
    wide = orders.enrich_order(orders.order_wide_facts(
        A.order_info(spark, sf_dir), A.order_detail(spark, sf_dir), slack, slack), dims, as_of)
    columns = ("order_id", "detail_id", "province_name", "user_age", "sku_name", "tm_name",
               "split_total_amount", "create_date")
    written = spark.read.schema("value string").text(site.topics.folder(S.DWM_ORDER_WIDE))
    stored = written.select(F.from_json("value", S.ORDER_WIDE).alias("r")).select("r.*")
    expected = rows(wide, *columns)
    assert rows(stored, *columns) == expected and expected

    jobs.payment_wide_job(site, delay="4000 days").awaitTermination(180)
    paid = orders.payment_wide(A.payment_info(spark, sf_dir), wide)
    columns = ("payment_id", "detail_id", "payment_create_time", "order_create_time", "user_id")
    written = spark.read.schema("value string").text(site.topics.folder(S.DWM_PAYMENT_WIDE))
    stored = written.select(F.from_json("value", S.PAYMENT_WIDE).alias("r")).select("r.*")
    expected = rows(paid, *columns)
    assert rows(stored, *columns) == expected and expected

    end = '{"order_id":-1,"province_id":-1,"create_time":"2100-01-01 00:00:00"}'
    more = site.read(S.DWM_ORDER_WIDE, S.ORDER_WIDE)
    put(site, "order_end", [end])
    both = more.unionByName(site.read("order_end", S.ORDER_WIDE))
    got = stream_rows(spark, stats.province_stats(both, "1 day", F.lit(1)), "prov",
                      "stt", "province_name", "order_amount", "order_count")
    want = rows(stats.province_stats(wide, "1 day", F.lit(1)),
                "stt", "province_name", "order_amount", "order_count")
    assert got == want and want


def test_log_chain_and_restart(spark, sf_dir, site):
    """Raw logs to visitor and keyword statistics; a second run adds nothing."""
    texts = texts_of(A.log_topic(spark, sf_dir))
    put(site, S.ODS_LOG, [*texts, log_text("end", SENTINEL)])
    for _ in range(2):
        jobs.log_job(site, delay="40 days").awaitTermination(180)
    folder = site.topics.folder(S.DWD_PAGE)
    counts = {r.topic: r.n for r in spark.read.text(folder).groupBy("topic")
              .agg(F.count("*").alias("n")).collect()}
    want = logs.split_log(logs.parse_log(A.log_topic(spark, sf_dir)))
    assert counts == {
        S.DWD_START: want["start"].count(), S.DWD_PAGE: want["page"].count(),
        S.DWD_DISPLAY: logs.explode_displays(want["display"]).count()}

    # The folder's own log decides which files count, so the last record comes from beside it.
    put(site, "page_end", [log_text("end", SENTINEL)])
    batch = logs.page_views(logs.parse_log(
        spark.read.schema("value string, topic string").text(folder)
             .where(F.col("topic") == S.DWD_PAGE).select("value")), keep=())
    flat = jobs._flat_pages(site, S.DWD_PAGE).unionByName(
        logs.page_views(site.read("page_end", S.LOG), keep=()))
    rows_in = metrics.visitor_metrics(flat, flat, flat)
    got = stream_rows(spark, stats.visitor_stats(rows_in, "1 hour", F.lit(1), "40 days"), "vs",
                      "stt", "vc", "ch", "ar", "is_new", "pv_ct", "sv_ct", "uv_ct", "dur_sum")
    want = rows(stats.visitor_stats(metrics.visitor_metrics(batch, batch, batch), "1 hour",
                                    F.lit(1)),
                "stt", "vc", "ch", "ar", "is_new", "pv_ct", "sv_ct", "uv_ct", "dur_sum")
    assert got == want and want


def test_visitor_jobs(spark, site):
    """Daily visitor and bounce jobs from the page topic to theirs."""
    put(site, S.DWD_PAGE, [log_text("1", 1000), log_text("1", 2000, "b", "a"),
                           log_text("2", 1000), log_text("end", SENTINEL)])
    for _ in range(2):
        jobs.uv_job(site).awaitTermination(120)
        jobs.jump_job(site).awaitTermination(120)
    uv = logs.parse_log(spark.read.text(site.topics.folder(S.DWM_UV)))
    uj = logs.parse_log(spark.read.text(site.topics.folder(S.DWM_UJ)))
    assert rows(uv, "common.mid", "ts") == [("1", 1000), ("2", 1000)]
    assert rows(uj, "common.mid", "page.page_id") == [("2", "home")]


def visitor_result(spark, site):
    found = spark.read.parquet(f"{site.tables}/visitor_stats")
    return rows(found, "stt", "pv_ct", "sv_ct")


def test_late_rows_are_written_out(spark, site):
    """A row behind the watermark goes to the late topic, one at its edge does not; a restart
    and a repeated batch keep the watermark; the statistics get every timely row."""
    def run():
        split, table = jobs.visitor_stats_with_late_job(site, "5 seconds", "20 seconds", F.lit(0))
        split.awaitTermination(120)
        assert split.exception() is None
        table.awaitTermination(120)
        # What was split after the table's query began is read by one that starts afterwards.
        jobs.visitor_stats_with_late_job(site, "5 seconds", "20 seconds", F.lit(0))[1] \
            .awaitTermination(120)

    for topic in (S.DWM_UV, S.DWM_UJ):
        put(site, topic, [])
    base = 1_704_067_200_000
    put(site, S.DWD_PAGE, [log_text("1", base + 1000, "a", "b"), log_text("2", base + 40_000, "a", "b")],
        "p0")                                                   # leaves a watermark of 20 s
    run()
    put(site, S.DWD_PAGE, [log_text("3", base + 14_999, "late", "b"),     # window ends at 15 s
                           log_text("4", base + 19_999, "late", "b"),     # ends at 20 s: passed
                           log_text("5", base + 20_000, "timely", "b"),   # ends at 25 s
                           log_text("6", base + 41_000, "timely", "b")], "p1")
    run()
    put(site, S.DWD_PAGE, [log_text("7", base + 300_000, "a", "b")], "p2")
    run()
    put(site, S.DWD_PAGE, [log_text("8", base + 100_000, "late", "b"),
                           log_text("9", SENTINEL, "a", "b")], "p3")
    run()
    late = stored(spark, site, f"{S.DWS_VISITORS}_late")
    assert sorted(r["ts"] - base for r in late) == [14_999, 19_999, 100_000]
    timely = stored(spark, site, f"{S.DWS_VISITORS}_timely")
    assert sorted(r["ts"] - base for r in timely if r["ts"] < SENTINEL) == [
        1000, 20_000, 40_000, 41_000, 300_000]
    assert [(s[11:], n) for s, n, _ in visitor_result(spark, site)] == [
        ("00:00:00", 1), ("00:00:20", 1), ("00:00:40", 2), ("00:05:00", 1)]
    marks = [f for _, dirs, _ in os.walk(f"{site.tables}/watermarks") for f in dirs
             if f.startswith("batch_id=")]
    assert len(marks) == 2      # the last one and the one it was made from


def test_product_chain(spark, sf_dir, site):
    """Eight topics to product statistics, then to keyword totals."""
    split = logs.split_log(logs.parse_log(A.log_topic(spark, sf_dir)))
    shown = logs.explode_displays(split["display"])
    wide = orders.order_wide_facts(A.order_info(spark, sf_dir), A.order_detail(spark, sf_dir),
                                   "30 days", "30 days")
    paid = orders.payment_wide(A.payment_info(spark, sf_dir), wide)
    refund, comment = A.refund_payment(spark, sf_dir), A.comment_info(spark, sf_dir)
    favor, cart = A.favor_info(spark, sf_dir), A.cart_info(spark, sf_dir)
    for topic, df in {S.DWD_PAGE: split["page"], S.DWD_DISPLAY: shown, S.DWD_FAVOR_INFO: favor,
                      S.DWD_CART_INFO: cart, S.DWM_ORDER_WIDE: wide,
                      S.DWM_PAYMENT_WIDE: paid, S.DWD_REFUND_PAYMENT: refund,
                      S.DWD_COMMENT_INFO: comment}.items():
        put(site, topic, texts_of(to_payload(df)))
    put(site, S.DWD_FAVOR_INFO, ['{"sku_id":0,"create_time":"2100-01-01 00:00:00"}'], "end")

    dims, one = A.dims(spark, sf_dir), F.lit(1)
    for query in jobs.product_stats_job(site, dims, window="1 day", stat_ts=one):
        query.awaitTermination(180)
    jobs.product_stats_job(site, dims, window="1 day", stat_ts=one)[1].awaitTermination(180)
    batch = jobs.enrich_product(stats.product_stats(metrics.union_all([
        metrics.clicks(logs.page_views(split["page"])), metrics.displays(shown),
        metrics.favors(favor), metrics.carts(cart), metrics.orders_m(wide),
        metrics.payments_m(paid), metrics.refunds_m(refund), metrics.comments(comment)]),
        "1 day", one).drop("window"), dims)
    columns = S.PRODUCT_STATS.names
    table = spark.read.parquet(f"{site.tables}/product_stats")
    want = rows(batch, *columns)
    assert rows(table, *columns) == want and want
    assert set(table.columns) - set(columns) == {"day", "run", "batch_id"}

    jobs.product_keyword_job(site, stat_ts=one).awaitTermination(120)
    words = spark.read.parquet(f"{site.tables}/product_keyword_stats")
    latest = firsts.latest_version(words, ["stt", "edt", "keyword", "source"], "batch_id")
    want = rows(stats.product_keyword_stats(batch, one), "stt", "keyword", "source", "ct")
    assert rows(latest, "stt", "keyword", "source", "ct") == want and want


def test_search_keyword_job(spark, sf_dir, site):
    texts = texts_of(A.page_map_topic(spark, sf_dir))
    end = ('{"page":{"page_id":"good_list","item_type":"keyword","item":"z"},'
           f'"ts":{SENTINEL}}}')
    put(site, S.DWD_PAGE, [*texts, end])
    jobs.search_keyword_job(site, window="1 hour", stat_ts=F.lit(1)).awaitTermination(120)
    batch = stats.search_keyword_stats(
        A.page_map_topic(spark, sf_dir).select(
            F.from_json("value", jobs.PAGE_MAP).alias("r")).select("r.*"), "1 hour", F.lit(1))
    columns = ("stt", "edt", "keyword", "source", "ct", "ts")
    want = rows(batch, *columns)
    assert rows(spark.read.parquet(f"{site.tables}/search_keyword_stats"), *columns) == want
    assert want


def change(table, kind, ts, **data):
    return json.dumps({"database": "shop", "table": table, "type": kind, "ts": ts, "xid": ts,
                       "data": data})


def test_changelog_job(spark, site, tmp_path):
    """Facts go to topics and dimensions to tables, by a configuration that may change."""
    def configure(*config_rows):
        (spark.createDataFrame([(*r, None, None) for r in config_rows], S.CONFIG)
         .coalesce(1).write.mode("overwrite").parquet(path))

    path = str(tmp_path / "config")
    configure(("user", "insert", "hbase", "dim_user", "id,name"),
              ("pay", "insert", "kafka", S.DWD_PAYMENT_INFO, "id"))
    put(site, S.ODS_DB, [change("user", "bootstrap-insert", 1, id=1, name="a", secret="s"),
                         change("pay", "insert", 2, id=7, extra=1),
                         change("cart", "insert", 3, sku_id=5)])
    jobs.changelog_job(site, path).awaitTermination(120)

    configure(("user", "insert", "hbase", "dim_user", "id,name"),
              ("user", "update", "hbase", "dim_user", "id,name"),
              ("cart", "insert", "kafka", S.DWD_CART_INFO, "sku_id"))
    put(site, S.ODS_DB, [change("user", "update", 5, id=1, name="b"),
                         change("user", "update", 4, id=1, name="late"),
                         change("cart", "insert", 6, sku_id=6)], "part-1")
    for _ in range(2):
        jobs.changelog_job(site, path).awaitTermination(120)
    assert rows(read_dim(spark, f"{site.tables}/dims", "dim_user", ["id", "name"])) == [
        ("1", "b")]
    written = spark.read.text(f"{site.topics.location}/{jobs.CHANGE_JOB}")
    assert rows(written, "topic", "value") == [
        (S.DWD_CART_INFO, '{"sku_id":6}'), (S.DWD_PAYMENT_INFO, '{"id":7}')]
    # A downstream job reads one topic out of the shared folder.
    assert stream_rows(spark, site.read(S.DWD_CART_INFO, S.CART_INFO), "carts",
                       "sku_id") == [(6,)]


def test_topic_tables(spark, site):
    """Topics as SQL tables with event time, and a stream kept in memory."""
    put(site, S.DWM_ORDER_WIDE, [
        '{"order_id":1,"province_id":2,"province_name":"n","split_total_amount":1.5,'
        '"create_time":"2024-01-01 00:00:01"}',
        '{"order_id":9,"create_time":"2100-01-01 00:00:00"}'])
    assert list(read_topics(spark, [S.DWM_ORDER_WIDE], site.topics)) == [S.DWM_ORDER_WIDE]
    topic_table(spark, S.DWM_ORDER_WIDE, S.ORDER_WIDE, site.topics, view="wide_view",
                event_time=F.col("create_time").cast("timestamp"))
    counts = spark.sql("""select date_format(w.start, 'HH:mm:ss') as stt, n from (
        select window(et, '5 seconds') as w, count(*) as n from wide_view
        group by window(et, '5 seconds'))""")
    assert stream_rows(spark, counts, "windows", "stt", "n") == [("00:00:00", 1)]
    wide = site.read(S.DWM_ORDER_WIDE, S.ORDER_WIDE)
    assert stream_rows(spark, stats.province_stats_sql(wide, stat_ts=1), "by_sql",
                       "stt", "province_name", "order_count") == [
        ("2024-01-01 00:00:00", "n", 1)]
    query = show_stream(wide.select("order_id"), "shown_rows")
    query.processAllAvailable()
    query.stop()
    assert rows(spark.table("shown_rows")) == [(1,), (9,)]


RICH = ('{"common":{"mid":"%s","vc":"v","ch":"c","ar":"a","is_new":"1","uid":"77","os":"ios"},'
        '"page":{"page_id":"home","item":"5","during_time":10,"source_type":"q"},'
        '"err":{"code":5},"displays":[{"item":"1","order":2,"extra":"x"}],"ts":%d}')


def stored(spark, site, topic):
    return [json.loads(r[0]) for r in
            spark.read.schema("value string").text(site.topics.folder(topic)).collect()
            ] if topic not in site.topics.shared else [
        json.loads(r[0]) for r in spark.read.schema("value string, topic string").text(
            site.topics.folder(topic)).where(F.col("topic") == topic).select("value").collect()]


def test_records_keep_all_their_fields(spark, site):
    """Fields that no reader knows reach the page, display, visitor and bounce topics."""
    put(site, S.ODS_LOG, [RICH % ("d1", 10_000), RICH % ("d1", 20_000), RICH % ("end", SENTINEL),
                          "not JSON", '{"common":null,"ts":1}'])
    jobs.log_job(site).awaitTermination(120)
    pages = [p for p in stored(spark, site, S.DWD_PAGE) if p["common"]["mid"] == "d1"]
    assert sorted((p["ts"], p["common"]["is_new"]) for p in pages) == [(10_000, "1"), (20_000, "0")]
    for p in pages:
        want = json.loads(RICH % ("d1", p["ts"]))
        want["common"]["is_new"] = p["common"]["is_new"]
        assert p == want
    shown = [d for d in stored(spark, site, S.DWD_DISPLAY) if d["mid"] == "d1"]
    assert len(shown) == 2
    assert all(d["extra"] == "x" and d["item"] == "5" and d["uid"] == "77" and d["order"] == 2
               and d["source_type"] == "q" for d in shown)
    jobs.rejects_job(site, S.ODS_LOG).awaitTermination(120)
    assert sorted((r["value"], r["reason"]) for r in stored(spark, site, "ods_log_rejected")) == [
        ("not JSON", "no JSON"), ('{"common":null,"ts":1}', "no device")]
    jobs.uv_job(site).awaitTermination(120)
    jobs.jump_job(site).awaitTermination(120)
    for topic in (S.DWM_UV, S.DWM_UJ):
        own = [r for r in stored(spark, site, topic) if r["common"]["mid"] == "d1"]
        assert own and all(r["err"] == {"code": 5} and r["common"]["os"] == "ios" for r in own)


def change_text(table, xid, data, kind="insert"):
    return json.dumps({"database": "shop", "table": table, "type": kind, "ts": 1, "xid": xid,
                       "xoffset": 0, "data": data})


def test_dimensions_stay_live(spark, site, tmp_path):
    """A product that arrives after its order is joined by the next batch, once."""
    names = {"user_info": {"id": 1, "gender": "F", "birthday": "1990-01-01"},
             "base_province": {"id": 2, "name": "N", "iso_3166_2": "x", "area_code": "1",
                               "iso_code": "c"},
             "spu_info": {"id": 3, "spu_name": "s"}, "base_trademark": {"id": 4, "tm_name": "t"},
             "base_category3": {"id": 5, "name": "c"}}
    sku = {"sku_name": "n", "price": "1.00", "spu_id": 3, "tm_id": 4, "category3_id": 5}
    config = str(tmp_path / "config")
    tables = [*names, "sku_info"]
    spark.createDataFrame(
        [(t, "insert", "hbase", f"dim_{t}", ",".join(names.get(t, {"id": 0, **sku})), "id", None)
         for t in tables], S.CONFIG).write.parquet(config)
    put(site, S.ODS_DB, [change_text(t, 1, row) for t, row in names.items()]
        + [change_text("sku_info", 2, {"id": 10, **sku})])
    jobs.changelog_job(site, config).awaitTermination(120)
    at = '"create_time":"2024-01-0%d 00:00:00"'

    def order(name, day, product):
        put(site, S.DWD_ORDER_INFO, ['{"id":%d,"user_id":1,"province_id":2,%s}'
                                     % (day, at % day)], name)
        put(site, S.DWD_ORDER_DETAIL, ['{"id":%d,"order_id":%d,"sku_id":%d,"sku_num":1,%s}'
                                       % (day, day, product, at % day)], name)

    def run(wait="1 day"):
        jobs.order_wide_job(site, jobs.dims_from_tables(site), delay="400 days",
                            wait=wait).awaitTermination(120)
        return sorted((r["order_id"], r["sku_name"]) for r in stored(spark, site, S.DWM_ORDER_WIDE))

    def waiting():
        return sorted(r.sku_id for r in spark.read.parquet(
            f"{site.tables}/waiting/{S.DWM_ORDER_WIDE}").groupBy("sku_id", "batch_id").count()
            .where(f"batch_id = {batches() - 1}").collect())

    def batches():
        return len([x for x in os.listdir(site.checkpoint(f"{S.DWM_ORDER_WIDE}/commits"))
                    if x.isdigit()])

    order("part-0", 1, 10)
    order("part-1", 2, 11)
    assert run() == [(1, "n")] and waiting() == [11]
    order("part-2", 3, 12)
    assert run() == [(1, "n")] and waiting() == [11, 12]
    # The product comes two batches after its order, which comes out once.
    put(site, S.ODS_DB, [change_text("sku_info", 3, {"id": 11, **sku, "sku_name": "new"})], "part-9")
    jobs.changelog_job(site, config).awaitTermination(120)
    order("part-3", 4, 11)
    assert run() == [(1, "n"), (2, "new"), (4, "new")] and waiting() == [12]
    order("part-4", 5, 10)
    assert run() == [(1, "n"), (2, "new"), (4, "new"), (5, "n")]
    # What has waited too long is put aside, and waits no more.
    order("part-5", 6, 10)
    assert run("1 millisecond") == [(1, "n"), (2, "new"), (4, "new"), (5, "n"), (6, "n")]
    missing = spark.read.parquet(f"{site.tables}/unmatched/{S.DWM_ORDER_WIDE}")
    assert [json.loads(r.value)["sku_id"] for r in missing.collect()] == [12]
    assert waiting() == []
    kept = os.listdir(f"{site.tables}/waiting/{S.DWM_ORDER_WIDE}")
    assert len(kept) == 1 and len([x for x in os.listdir(
        f"{site.tables}/waiting/{S.DWM_ORDER_WIDE}/{kept[0]}")]) == 2


def test_bad_changes_stop_no_job(spark, site, tmp_path):
    """Changes whose data are no object, or name a key twice, go to the rejected topic."""
    config = str(tmp_path / "config")
    spark.createDataFrame([("t", "insert", "kafka", S.DWD_CART_INFO, "id", None, None),
                           ("d", "insert", "hbase", "dim_d", "id", None, None)],
                          S.CONFIG).write.parquet(config)
    bad = [change_text(t, 9, data) for t in "td" for data in ("text", [1, 2, 3], 12345)]
    bad += [change_text("t", 9, {"id": 1}).replace('{"id": 1}', '{"id": 1, "id": 2}')]
    put(site, S.ODS_DB, [change_text("t", 1, {"id": 7}), *bad, change_text("d", 2, {"id": 8})])
    for _ in range(2):
        jobs.changelog_job(site, config).awaitTermination(120)
    assert stored(spark, site, S.DWD_CART_INFO) == [{"id": 7}]
    assert rows(read_dim(spark, f"{site.tables}/dims", "dim_d", ["id"])) == [("8",)]
    jobs.rejects_job(site, S.ODS_DB).awaitTermination(120)
    assert sorted((r["value"], r["reason"]) for r in stored(spark, site, "ods_db_rejected")) == sorted(
        (t, "no JSON" if '"id": 2' in t else "no data") for t in bad)


def test_bad_displays(spark, site):
    """A display that is no object has no payload; its record is named among the rejected."""
    text = ('{"common":{"mid":"1"},"page":{"page_id":"p"},"displays":[{"item":"1"},5,"x",null],'
            '"ts":1000}')
    parsed = logs.parse_log(spark.createDataFrame([(text,)], "value string"))
    shown = logs.routed_payloads(parsed).where(F.col("topic") == S.DWD_DISPLAY).collect()
    assert [json.loads(r.value)["item"] for r in shown] == ["1"]
    put(site, S.ODS_LOG, [text, log_text("2", 1)])
    jobs.rejects_job(site, S.ODS_LOG).awaitTermination(120)
    assert [(r["value"], r["reason"]) for r in stored(spark, site, "ods_log_rejected")] == [
        (text, "bad display")]


def test_dimension_store(spark, tmp_path):
    """No rows before the first fold; numbers that begin again; keys outside the kept columns."""
    root = str(tmp_path / "dims")
    rows_of = "sink_table string, pk array<string>, data map<string,string>, ts long, xid long, xoffset long"

    def batch(*versions):
        return spark.createDataFrame(
            [("dim_t", pk, {"id": "1", "name": name}, 1, xid, 0) for pk, name, xid in versions],
            rows_of)

    assert read_dim(spark, root, "dim_t", ["id", "name"]).collect() == []
    for i in range(3):
        upsert_dim(batch(), i, root, 2)
    upsert_dim(batch((["1"], "a", 1)), 3, root, 2)
    upsert_dim(batch((["1"], "b", 2)), 4, root, 2)
    upsert_dim(batch((["2"], "x", 2)), 5, root, 2)
    upsert_dim(batch((["1"], "c", 3), (None, "no", 4), ([None], "no", 5)), 0, root, 2)
    got = rows(read_dim(spark, root, "dim_t", ["name"]))
    assert got == [("c",), ("x",)]
    assert spark.read.parquet(f"{root}_rejected").count() == 2
    assert rows(read_dim(spark, root, "dim_none", ["name"])) == []


def test_key_outside_the_kept_columns(spark):
    config = spark.createDataFrame([("t", "insert", "hbase", "dim_t", "name", "id", None)], S.CONFIG)
    text = spark.createDataFrame([(change_text("t", i, {"id": i, "name": "n"}),) for i in range(3)],
                                 "value string")
    routed = C.route_by_sink(C.prune_columns(C.join_config(C.changelog_etl(text), config)))
    assert rows(C.dim_rows(routed).select(F.col("pk")[0], F.map_keys("data")[0])) == [
        ("0", "name"), ("1", "name"), ("2", "name")]


def test_bad_orders_stop_no_job(spark, sf_dir, site):
    """Unreadable times and numbers are left out and kept with a reason; good rows arrive."""
    order_site(spark, sf_dir, site)
    put(site, S.DWD_ORDER_INFO, ['{"id":1,"create_time":"soon"}', "{{", '{"id":"x"}'], "bad")
    jobs.rejects_job(site, S.DWD_ORDER_INFO).awaitTermination(120)
    assert sorted(r["reason"] for r in stored(spark, site, "dwd_order_info_rejected")) == [
        "no JSON", "no time", "no time"]
    dims, as_of = A.dims(spark, sf_dir), F.lit("2024-01-31").cast("date")
    jobs.order_wide_job(site, dims, as_of, "30 days", "30 days", "4000 days").awaitTermination(180)
    assert stored(spark, site, S.DWM_ORDER_WIDE)
    bad = spark.createDataFrame([("abc", 1, "sku_id"), ("5", 2, "sku_id")],
                                "item string, ts long, item_type string")
    assert rows(metrics.clicks(bad).where("sku_id is not null"), "sku_id", "ts") == [(5, 2)]


def test_result_table_over_resets_and_compaction(spark, site):
    """A lost checkpoint loses nothing, a repeated batch adds nothing, a day becomes one folder."""
    schema = "stt string, n long"

    def feed(n):
        put(site, "figures", [f'{{"stt":"2024-01-0{1 + n % 2} 00:00:00","n":{n}}}'], f"part-{n}")

    def run():
        query = site.to_table(site.read("figures", spark.createDataFrame([], schema).schema), "figures")
        query.awaitTermination(120)

    def stored_n():
        return sorted(r.n for r in spark.read.parquet(f"{site.tables}/figures").collect())

    feed(1)
    run()
    feed(2)
    run()
    assert stored_n() == [1, 2]
    fresh = jobs.Site(spark, site.topics, site.tables, f"{site.checkpoints}-new", trigger=None)
    query = fresh.to_table(fresh.read("figures", spark.createDataFrame([], schema).schema), "figures")
    query.awaitTermination(120)
    assert stored_n() == [1, 1, 2, 2]  # the new run reads all again and replaces nothing
    compact_day(spark, f"{site.tables}/figures", "2024-01-01")
    compact_day(spark, f"{site.tables}/figures", "2024-01-01")
    assert stored_n() == [1, 1, 2, 2]
    assert os.listdir(f"{site.tables}/figures/day=2024-01-01") != [] and {
        d for d in os.listdir(f"{site.tables}/figures/day=2024-01-01") if "=" in d} == {"run=compacted"}


def test_failure_between_write_and_commit(spark, site, monkeypatch):
    """The batch function breaks after its output: the restart writes the batch once."""
    from brookmart.sinks import tables
    put(site, "figures", ['{"stt":"2024-01-01 00:00:00","n":1}'])
    real = tables._write_partitions
    state = {"left": 1}

    def breaks(*args):
        real(*args)
        if state["left"]:
            state["left"] = 0
            raise RuntimeError("after the write")

    monkeypatch.setattr(tables, "_write_partitions", breaks)
    schema = spark.createDataFrame([], "stt string, n long").schema
    with pytest.raises(Exception, match="after the write"):
        site.to_table(site.read("figures", schema), "figures").awaitTermination(120)
    site.to_table(site.read("figures", schema), "figures").awaitTermination(120)
    assert [r.n for r in spark.read.parquet(f"{site.tables}/figures").collect()] == [1]


def test_configuration_changes_routing(spark, site, tmp_path):
    config = str(tmp_path / "config")

    def set_sink(seq, sink, target):
        row = {"kind": "+U", "source_table": "t", "operate_type": "insert", "sink_type": sink,
               "sink_table": target, "sink_columns": "id", "sink_pk": "id", "seq": seq}
        put(site, "table_process", [json.dumps(row)], f"part-{seq}")
        schema = "kind string, " + ", ".join(f"{c} string" for c in S.CONFIG.names) + ", seq long"
        jobs.config_job(site, site.read("table_process", spark.createDataFrame([], schema).schema),
                        config).awaitTermination(120)

    set_sink(1, "kafka", S.DWD_CART_INFO)
    put(site, S.ODS_DB, [change_text("t", 1, {"id": 1})], "part-1")
    jobs.changelog_job(site, config).awaitTermination(120)
    set_sink(2, "kafka", S.DWD_FAVOR_INFO)
    set_sink(0, "kafka", S.DWD_COMMENT_INFO)  # an older change comes late
    put(site, S.ODS_DB, [change_text("t", 2, {"id": 2})], "part-2")
    jobs.changelog_job(site, config).awaitTermination(120)
    assert stored(spark, site, S.DWD_CART_INFO) == [{"id": 1}]
    assert stored(spark, site, S.DWD_FAVOR_INFO) == [{"id": 2}]
