"""The warehouse's streaming jobs, from topic to topic or table.

Each job starts a query of its own checkpoint folder and returns it.  A stream join waits
for its slower input.  A union whose watermark is set after it, as in the statistics, follows
its fastest topic: rows of slower topics that come later than the delay are dropped as late.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from brookmart import schemas as S
from brookmart.functions.records import is_object, parse_typed, pick, to_payload
from brookmart.functions.times import duration_ms, event_time
from brookmart.operators import changelog as C
from brookmart.operators import logs as L
from brookmart.operators import metrics as M
from brookmart.operators.enrich import DIM_COLUMNS, enrich_product
from brookmart.operators.windows import is_late
from brookmart.plans import orders, stats
from brookmart.sinks.tables import (remove_folder, store_config, upsert_dim, write_batch,
                                    write_stats, write_waiting)
from brookmart.sinks.topics import (TRIGGER, create_topic, run_id, start, write_batch_by_topic,
                                    write_by_topic, write_topic)
from brookmart.sources.tables import read_config, read_dim, read_waiting
from brookmart.sources.topics import TopicStore, read_ods_log, read_topic, typed
from brookmart.streaming import stateful

LOG_JOB = "log_split"
CHANGE_JOB = "changelog_split"

# Topics written together by one job share its folder when topics are files.
SHARED = {S.DWD_START: LOG_JOB, S.DWD_PAGE: LOG_JOB, S.DWD_DISPLAY: LOG_JOB,
          S.DWD_ORDER_INFO: CHANGE_JOB, S.DWD_ORDER_DETAIL: CHANGE_JOB,
          S.DWD_PAYMENT_INFO: CHANGE_JOB, S.DWD_FAVOR_INFO: CHANGE_JOB,
          S.DWD_CART_INFO: CHANGE_JOB, S.DWD_REFUND_PAYMENT: CHANGE_JOB,
          S.DWD_COMMENT_INFO: CHANGE_JOB,
          S.DWM_ORDER_WIDE: f"{S.DWM_ORDER_WIDE}_job",
          S.DWS_PRODUCT_STATS: f"{S.DWS_PRODUCT_STATS}_job",
          f"{S.DWS_VISITORS}_timely": f"{S.DWS_VISITORS}_job",
          f"{S.DWS_VISITORS}_late": f"{S.DWS_VISITORS}_job"}


@dataclass(frozen=True)
class Site:
    """Where a deployment keeps its topics, result tables and checkpoints."""

    spark: SparkSession
    topics: TopicStore
    tables: str
    checkpoints: str
    trigger: str | None = TRIGGER

    def checkpoint(self, job: str) -> str:
        return f"{self.checkpoints}/{job}"

    def read(self, topic: str, schema: T.StructType) -> DataFrame:
        return typed(read_topic(self.spark, topic, self.topics), schema)

    def to_topic(self, df: DataFrame, topic: str) -> StreamingQuery:
        return write_topic(to_payload(df), topic, self.topics, self.checkpoint(topic),
                           self.trigger)

    def whole_to_topic(self, df: DataFrame, topic: str) -> StreamingQuery:
        """Records as they came, all their fields included."""
        return write_topic(df.select(F.col("raw").alias("value")), topic, self.topics,
                           self.checkpoint(topic), self.trigger)

    def to_table(self, df: DataFrame, table: str, mode: str = "append") -> StreamingQuery:
        return write_stats(df, f"{self.tables}/{table}", self.checkpoint(table), mode,
                           self.trigger)


def _keyed(rows: DataFrame, *fields: str) -> DataFrame:
    """Whole records as text with device, time, position and what else a rule needs."""
    named = parse_typed(rows.withColumn("raw", F.col("value")),
                        pick(S.LOG, ["common.mid", "ts", *fields]))
    return named.select("raw", "pos", "ts", "common.mid", *fields).where(
        "mid is not null and ts is not null")


def _page_log(site: Site, *fields: str) -> DataFrame:
    return _keyed(read_topic(site.spark, S.DWD_PAGE, site.topics), *fields)


def _flat_pages(site: Site, topic: str) -> DataFrame:
    return L.page_views(site.read(topic, S.LOG), keep=())


def log_job(site: Site, raw: DataFrame | None = None, window: str = "5 seconds",
            delay: str = "3 seconds") -> StreamingQuery:
    """Raw logs -> repaired visitor flag -> start, page and display topics, in one pass."""
    raw = read_topic(site.spark, S.ODS_LOG, site.topics) if raw is None else raw
    flagged = stateful.flag_new_visitor_stream(
        _keyed(raw).withColumn("is_new", F.lit(None).cast("string")), window=window, delay=delay)
    fixed = L.parse_log(flagged.select(F.col("raw").alias("value"), "is_new")).withColumn(
        "common", F.col("common").withField("is_new", F.col("is_new")))
    return write_by_topic(L.routed_payloads(fixed), LOG_JOB, site.topics,
                          site.checkpoint(LOG_JOB), site.trigger)


def rejected(rows: DataFrame, required: dict[str, str]) -> DataFrame:
    """Records that a job cannot use, as JSON text of the record and the reason.

    `required` has a JSON path and type for each name; what none of the readers can do
    without is missing if the path is absent or does not convert.  The type `object` asks for
    a JSON object with distinct keys, `objects` for nothing but such in an array, if there is
    one; of a record with bad elements the good ones still go their way.
    """
    parsed = rows.withColumn("_v", F.try_parse_json("value"))
    reason = F.when(F.col("_v").isNull(), "no JSON")
    for name, where in required.items():
        path, kind = where.split()
        text = F.try_variant_get("_v", path, "string")
        if kind == "object":
            reason = reason.when(~is_object(F.coalesce(text, F.lit(""))), f"no {name}")
        elif kind == "objects":
            reason = reason.when(F.exists(
                F.try_variant_get("_v", path, "array<variant>"),
                lambda d: d.try_cast("map<string, variant>").isNull()), f"bad {name}")
        else:
            reason = reason.when(text.isNull() | text.try_cast(kind).isNull(), f"no {name}")
    return (parsed.withColumn("reason", reason).where(F.col("reason").isNotNull())
                  .select(F.to_json(F.struct("value", "reason")).alias("value")))


def rejects_job(site: Site, topic: str) -> StreamingQuery:
    """Records of a topic that its jobs leave out, with the reason, to `<topic>_rejected`."""
    if topic in (S.ODS_LOG, S.DWD_PAGE):
        required = {"device": "$.common.mid string", "time": "$.ts bigint",
                    "display": "$.displays objects"}
    elif topic == S.ODS_DB:
        required = {"table": "$.table string", "data": "$.data object"}
    else:
        required = {"time": "$.create_time timestamp"}
    bad = rejected(read_topic(site.spark, topic, site.topics), required)
    return write_topic(bad, f"{topic}_rejected", site.topics,
                       site.checkpoint(f"{topic}_rejected"), site.trigger)


def log_files_job(site: Site, folder: str) -> StreamingQuery:
    """`log_job` fed from day-rolled log files."""
    return log_job(site, read_ods_log(site.spark, folder, stream=True))


def uv_job(site: Site, **options) -> StreamingQuery:
    return site.whole_to_topic(stateful.daily_uv_stream(_page_log(site), **options), S.DWM_UV)


def jump_job(site: Site, gap: str = "5 seconds", **options) -> StreamingQuery:
    uj = stateful.user_jump_stream(_page_log(site, "page.last_page_id"), gap, **options)
    return site.whole_to_topic(uj, S.DWM_UJ)


def config_job(site: Site, changes: DataFrame, config_path: str) -> StreamingQuery:
    """Changes of the configuration (`kind`, its columns, `seq`) to the stored table that
    `changelog_job` reads before each of its batches."""
    def fold(batch: DataFrame, batch_id: int) -> None:
        store_config(batch, config_path)

    return start(changes.writeStream.foreachBatch(fold), site.checkpoint("config"), site.trigger,
                 "config")


def changelog_job(site: Site, config_path: str, database: str = "shop") -> StreamingQuery:
    """Change records -> fact topics and dimension tables, by the stored configuration.

    The configuration is read again for every micro-batch, before its data.
    """
    changes = C.changelog_etl(read_topic(site.spark, S.ODS_DB, site.topics), database)

    def split_batch(batch: DataFrame, batch_id: int) -> None:
        config = read_config(batch.sparkSession, config_path)
        routed = C.route_by_sink(C.prune_columns(C.join_config(batch, config))).persist()
        try:
            write_batch_by_topic(C.topic_rows(routed), batch_id, CHANGE_JOB, site.topics)
            upsert_dim(C.dim_rows(routed), batch_id, f"{site.tables}/dims")
        finally:
            routed.unpersist()

    return start(changes.writeStream.foreachBatch(split_batch), site.checkpoint(CHANGE_JOB),
                 site.trigger, CHANGE_JOB)


WAIT = "1 day"      # how long a fact waits for its dimension rows

Dims = dict[str, DataFrame] | Callable[[], dict[str, DataFrame]]


def dims_from_tables(site: Site) -> Callable[[], dict[str, DataFrame]]:
    """The dimensions that `changelog_job` keeps, as stored at the time of the call."""
    return lambda: {name: read_dim(site.spark, f"{site.tables}/dims", f"dim_{name}", columns)
                    for name, columns in DIM_COLUMNS.items()}


def enrich_to_topic(site: Site, facts: DataFrame, topic: str, dims: Dims,
                    rich: Callable[[DataFrame, dict[str, DataFrame]], DataFrame],
                    wait: str = WAIT) -> StreamingQuery:
    """Facts of each micro-batch enriched with the dimensions of that moment, to a topic.

    Facts without their dimension rows wait in `<tables>/waiting/<topic>` and are tried again
    in every batch; the first one that finds the rows writes them.  What has waited for `wait`
    goes to `<tables>/unmatched/<topic>` as JSON text.

    A batch reads what the batch before it left and writes what it leaves itself, so a
    repeated batch does the same again.  Waiting facts belong to their checkpoint: a job that
    starts afresh reads its topics again too.
    """
    columns = facts.columns
    left = f"{site.tables}/waiting/{topic}"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        now = dims() if callable(dims) else dims
        own = f"{left}/run={run_id(spark)}"
        fresh = batch.select(*columns, F.unix_millis(F.current_timestamp()).alias("_since"))
        due = fresh.unionByName(read_waiting(spark, f"{own}/batch_id={batch_id - 1}",
                                             fresh.schema))
        due = due.withColumn("_fact", F.xxhash64(*columns)).persist()
        try:
            found = rich(due.drop("_since"), now).persist()
            try:
                missing = due.join(found.select("_fact").distinct(), "_fact", "left_anti").drop(
                    "_fact").persist()
                rows = to_payload(found.drop("_fact")).withColumn("topic", F.lit(topic))
                write_batch_by_topic(rows, batch_id, f"{topic}_job", site.topics)
                old = F.col("_since") <= F.unix_millis(F.current_timestamp()) - duration_ms(wait)
                missing = missing.withColumn("_old", old)
                write_batch(to_payload(missing.where("_old").select(*columns)),
                            f"{site.tables}/unmatched/{topic}", batch_id)
                write_waiting(missing.where("not _old").drop("_old"),
                              f"{own}/batch_id={batch_id}")
                remove_folder(spark, f"{own}/batch_id={batch_id - 2}")
                missing.unpersist()
            finally:
                found.unpersist()
        finally:
            due.unpersist()

    create_topic(site.spark, topic, f"{topic}_job", site.topics)  # readers may start meanwhile
    return start(facts.writeStream.foreachBatch(write), site.checkpoint(topic), site.trigger,
                 topic)


def order_wide_job(site: Site, dims: Dims, as_of: Column | None = None,
                   lower: str = orders.ORDER_SLACK, upper: str = orders.ORDER_SLACK,
                   delay: str = orders.ORDER_DELAY, wait: str = WAIT) -> StreamingQuery:
    facts = orders.order_wide_facts(site.read(S.DWD_ORDER_INFO, S.ORDER_INFO),
                                    site.read(S.DWD_ORDER_DETAIL, S.ORDER_DETAIL),
                                    lower, upper, delay)
    return enrich_to_topic(site, facts, S.DWM_ORDER_WIDE, dims, lambda batch, now: (
        orders.enrich_order(batch, now, as_of, keep=("_fact",))), wait)


def payment_wide_job(site: Site, **options) -> StreamingQuery:
    paid = orders.payment_wide(site.read(S.DWD_PAYMENT_INFO, S.PAYMENT_INFO),
                               site.read(S.DWM_ORDER_WIDE, S.ORDER_WIDE), **options)
    return site.to_topic(paid, S.DWM_PAYMENT_WIDE)


def visitor_rows(site: Site) -> DataFrame:
    return M.visitor_metrics(_flat_pages(site, S.DWD_PAGE), _flat_pages(site, S.DWM_UV),
                             _flat_pages(site, S.DWM_UJ))


def visitor_stats_job(site: Site, **options) -> StreamingQuery:
    return site.to_table(stats.visitor_stats(visitor_rows(site), **options), "visitor_stats")


def split_late_job(site: Site, rows: DataFrame, name: str, window: str, delay: str,
                   ts: str = "ts") -> StreamingQuery:
    """Rows whose window the watermark has passed to `<name>_late`, others to `<name>_timely`.

    The watermark of a micro-batch is the largest event time of the batches before it less
    `delay`, and never goes back.  Each batch stores the one it leaves to the next, so a
    repeated batch, or one after a restart, splits its rows the same way.

    A windowed query over the timely topic with the same window and delay drops none of them:
    what it reads at once are whole batches of this job, so its own watermark is behind the one
    under which they were passed.
    """
    topics, marks = f"{name}_job", f"{site.tables}/watermarks/{name}"
    create_topic(site.spark, f"{name}_timely", topics, site.topics)
    create_topic(site.spark, f"{name}_late", topics, site.topics)

    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = f"{marks}/run={run_id(spark)}"
        before = read_waiting(spark, f"{own}/batch_id={batch_id - 1}", MARK)
        passed = before.agg(F.max("mark")).first()[0]      # the table holds one number
        batch = batch.persist()
        try:
            late = is_late(event_time(ts), F.timestamp_millis(F.lit(passed).cast("long")), window)
            topic = F.when(late, f"{name}_late").otherwise(f"{name}_timely")
            write_batch_by_topic(batch.select(
                topic.alias("topic"), F.to_json(F.struct(*batch.columns)).alias("value")),
                batch_id, topics, site.topics)
            top = batch.agg((F.max(ts) - duration_ms(delay)).cast("long").alias("mark"))
            write_waiting(before.union(top).agg(F.max("mark").alias("mark")).coalesce(1),
                          f"{own}/batch_id={batch_id}")
            remove_folder(spark, f"{own}/batch_id={batch_id - 2}")
        finally:
            batch.unpersist()

    return start(rows.writeStream.foreachBatch(split), site.checkpoint(f"{name}_split"),
                 site.trigger, f"{name}_split")


def visitor_stats_with_late_job(site: Site, window: str = stats.WINDOW,
                                delay: str = stats.VISITOR_DELAY,
                                stat_ts: Column | None = None) -> list[StreamingQuery]:
    """`visitor_stats_job` that writes the metric rows it leaves out to `dws_visitors_late`."""
    rows = visitor_rows(site)
    split = split_late_job(site, rows, S.DWS_VISITORS, window, delay)     # makes the topics
    timely = site.read(f"{S.DWS_VISITORS}_timely", rows.schema)
    return [split,
            site.to_table(stats.visitor_stats(timely, window, stat_ts, delay), "visitor_stats")]


def product_metrics(site: Site) -> DataFrame:
    return M.union_all([
        M.clicks(_flat_pages(site, S.DWD_PAGE)),
        M.displays(site.read(S.DWD_DISPLAY, S.DISPLAY)),
        M.favors(site.read(S.DWD_FAVOR_INFO, S.FAVOR_INFO)),
        M.carts(site.read(S.DWD_CART_INFO, S.CART_INFO)),
        M.orders_m(site.read(S.DWM_ORDER_WIDE, S.ORDER_WIDE)),
        M.payments_m(site.read(S.DWM_PAYMENT_WIDE, S.PAYMENT_WIDE)),
        M.refunds_m(site.read(S.DWD_REFUND_PAYMENT, S.REFUND_PAYMENT)),
        M.comments(site.read(S.DWD_COMMENT_INFO, S.COMMENT_INFO))])


def product_stats_job(site: Site, dims: Dims, **options) -> list[StreamingQuery]:
    """Statistics to their topic, and from there to the result table."""
    sums = stats.product_stats(product_metrics(site), **options).drop("window")
    return [enrich_to_topic(site, sums, S.DWS_PRODUCT_STATS, dims, lambda batch, now: (
                enrich_product(batch, now).select(*S.PRODUCT_STATS.names, "_fact"))),
            site.to_table(site.read(S.DWS_PRODUCT_STATS, S.PRODUCT_STATS), "product_stats")]


def province_stats_job(site: Site, **options) -> StreamingQuery:
    wide = site.read(S.DWM_ORDER_WIDE, S.ORDER_WIDE)
    return site.to_table(stats.province_stats(wide, **options), "province_stats")


MARK = "mark long"

PAGE_MAP = T.StructType([
    T.StructField("page", T.MapType(T.StringType(), T.StringType())),
    T.StructField("ts", T.LongType())])


def search_keyword_job(site: Site, **options) -> StreamingQuery:
    pages = site.read(S.DWD_PAGE, PAGE_MAP)
    return site.to_table(stats.search_keyword_stats(pages, **options), "search_keyword_stats")


def product_keyword_job(site: Site, **options) -> StreamingQuery:
    """Running totals; every refreshed total is written, the latest one counts."""
    source = site.read(S.DWS_PRODUCT_STATS, S.PRODUCT_STATS)
    return site.to_table(stats.product_keyword_stats(source, **options),
                         "product_keyword_stats", "update")
