"""Every query of the engine over the test tables, by name."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import schemas
from tidemark.functions import decode as wire
from tidemark.functions.times import naive
from tidemark.operators import lookup as lookups, maintenance, quality
from tidemark.operators.enrich import DIM_COLUMNS, enriched, silver
from tidemark.operators.health import health, health_stream
from tidemark.plans import analytics, bindings, demo
from tidemark.session import configure, uncounted_state
from tidemark.sources import messages
from tidemark.sources.dimension import DeviceDimension
from tidemark.sources.lake import Lake
from tidemark.sources.scratch import folder as shared_dir
from tidemark.streaming import live, stateful, watch
from tidemark.streaming.jobs import CATCH_UP, Lakehouse, finish
from tidemark.streaming.monitor import FreshnessMonitor

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}


def _query(run: Query) -> Query:
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(configure(spark), sf_dir)

    _queries[run.__name__] = prepared
    return run


def queries() -> dict[str, Query]:
    return dict(_queries)


def _steady(df: DataFrame) -> DataFrame:
    """Averages to nine decimals: the last bits of a sum depend on the order it was taken in."""
    return df.withColumns({c: F.round(c, 9) for c in ("avg_temperature", "avg_energy_usage")})


def _silver(spark, sf_dir) -> DataFrame:
    dim = bindings.device_seed(spark)
    return silver(bindings.telemetry(spark, sf_dir), dim, bindings.arrival())


def _gold(spark, sf_dir, size="1 minute") -> DataFrame:
    return health(_silver(spark, sf_dir), "ingest_time", size)


def _newest(df: DataFrame, column: str) -> dt.datetime:
    return df.agg(F.max(column)).first()[0]


# ---- messages ----


def _landed_messages(spark, sf_dir, topic) -> DataFrame:
    return spark.read.schema("value STRING").text(f"{demo.lakehouse(spark, sf_dir).root}/inbox/{topic}/*")


@_query
def decode_telemetry(spark, sf_dir):
    """The JSON lines of every reading, decoded."""
    raw = _landed_messages(spark, sf_dir, "telemetry")
    return wire.accepted(wire.decode(raw, schemas.TELEMETRY), schemas.TELEMETRY)


@_query
def decode_events(spark, sf_dir):
    """The JSON lines of every device event, decoded."""
    raw = _landed_messages(spark, sf_dir, "events")
    return wire.accepted(wire.decode(raw, schemas.EVENTS), schemas.EVENTS)


def _mangled(spark, sf_dir) -> DataFrame:
    """Every reading as a message, seven in eight of them spoiled in a different way."""
    at = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    fields = [at.alias("event_time") if c == "event_time" else F.col(c) for c in schemas.TELEMETRY.names]
    raw = bindings.telemetry(spark, sf_dir).select(
        "reading_id", at.alias("_at"), F.explode(F.array(F.to_json(F.struct(*fields)))).alias("_good")
    )
    good, at = F.col("_good"), F.col("_at")
    way = F.col("reading_id") % 8
    value = (
        F.when(way == 1, F.replace(good, at, F.replace(at, F.lit("T"), F.lit(" "))))
        .when(way == 2, F.replace(good, at, F.concat(at, F.lit("+00:00"))))
        .when(way == 3, F.regexp_replace(good, '"temperature":[^,]+,', ""))
        .when(way == 4, good.substr(F.lit(2), F.length(good)))
        .when(way == 5, F.regexp_replace(good, '"signal_strength":\\d+', '"signal_strength":"weak"'))
        .when(way == 6, F.regexp_replace(good, '"(temperature|vibration)":[^,]+,', '"$1":"x",'))
        .when(way == 7, F.lit(None))
        .otherwise(good)
    )
    return raw.select(F.col("reading_id").alias("message_id"), F.explode(F.array(value)).alias("value"))


@_query
def decode_tolerant(spark, sf_dir):
    """Spoiled messages decoded: a bad field is NULL, a bad message gets a reason."""
    return wire.decode(_mangled(spark, sf_dir), schemas.TELEMETRY, keep=("message_id",)).drop("value")


@_query
def decode_quarantine(spark, sf_dir):
    """What the spoiled messages put in quarantine, by reason."""
    decoded = wire.decode(_mangled(spark, sf_dir), schemas.TELEMETRY)
    return wire.quarantined(decoded).groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))


@_query
def decode_timestamp(spark, sf_dir):
    """Timestamp texts in seven forms; only the naive ISO ones are times."""
    events = bindings.events_table(spark, sf_dir)
    form = F.col("event_id") % 7
    day, clock = F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss")
    iso = F.concat(day, F.lit("T"), clock)
    text = (
        F.when(form == 1, F.concat(day, F.lit(" "), clock))
        .when(form == 2, F.concat(iso, F.lit("+00:00")))
        .when(form == 3, F.concat(F.lit("2024-99-01T"), clock))
        .when(form == 4, F.lit(None))
        .when(form == 5, F.concat(iso, F.date_format("ts", ".SSSSSS")))
        .when(form == 6, day)
        .otherwise(iso)
    )
    return events.select("event_id", wire.iso_timestamp(text).alias("event_time"))


# ---- bronze and the dimension ----


@_query
def bronze_telemetry(spark, sf_dir):
    return demo.lakehouse(spark, sf_dir).telemetry.read()


@_query
def bronze_events(spark, sf_dir):
    return demo.lakehouse(spark, sf_dir).events.read()


@_query
def dim_seed(spark, sf_dir):
    """The seeded dimension beside the readings each device sent, unknown devices included."""
    house = demo.lakehouse(spark, sf_dir)
    return quality.device_coverage(house.telemetry.read(), house.dimension.current())


@_query
def dim_upsert(spark, sf_dir):
    """The seed, overlaid with every device's last change."""
    dim = DeviceDimension(spark, shared_dir(spark, "dimension"), slices=4)
    dim.seed()
    dim.upsert(bindings.device_changes(spark, sf_dir), ["valid_from", "temp_threshold", "model", "location_id"])
    return dim.current()


@_query
def lookup_join(spark, sf_dir):
    return enriched(bindings.telemetry(spark, sf_dir), bindings.device_seed(spark))


@_query
def lookup_join_shuffled(spark, sf_dir):
    """The lookup against a dimension too large to broadcast: one device per user."""
    device = F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    readings = bindings.events_table(spark, sf_dir).select(
        F.col("event_id").alias("reading_id"), device.alias("device_id"), F.col("value").alias("temperature")
    )
    changes = bindings.device_changes(spark, sf_dir, device)
    dim = lookups.latest_per_device(changes, ["valid_from", "temp_threshold", "model", "location_id"])
    return lookups.lookup(readings, dim, DIM_COLUMNS, broadcast=False)


@_query
def lookup_join_asof(spark, sf_dir):
    """Each reading with the device row in force at its own event time."""
    changes = bindings.device_changes(spark, sf_dir)
    versions = changes.groupBy("device_id", "valid_from").agg(F.max(F.struct(*DIM_COLUMNS)).alias("v"))
    versions = versions.select("device_id", "valid_from", "v.*")
    readings = bindings.telemetry(spark, sf_dir).select("reading_id", "device_id", "event_time", "temperature")
    return lookups.lookup_as_of(readings, versions, "event_time", DIM_COLUMNS)


# ---- silver and gold ----


@_query
def silver_enriched(spark, sf_dir):
    return _silver(spark, sf_dir)


@_query
def gold_health(spark, sf_dir):
    return _steady(_gold(spark, sf_dir))


@_query
def gold_health_hourly(spark, sf_dir):
    return _steady(_gold(spark, sf_dir, "1 hour"))


@_query
def gold_health_daily(spark, sf_dir):
    """Windows dense enough that most of the work is done before the shuffle."""
    return _steady(_gold(spark, sf_dir, "1 day"))


@_query
def gold_health_event_time(spark, sf_dir):
    return _steady(health(_silver(spark, sf_dir), "event_time"))


@_query
def stream_silver(spark, sf_dir):
    """Silver as the enrichment job wrote it."""
    return demo.lakehouse(spark, sf_dir).silver.read()


@_query
def stream_gold(spark, sf_dir):
    """Gold as the windowing job wrote it, over arrival time."""
    return _steady(demo.lakehouse(spark, sf_dir).gold.read())


def _windows_to_files(readings: DataFrame, out: str):
    """Event-time windows, as far as they are closed, appended to ``out``/gold."""
    with uncounted_state(readings.sparkSession):
        return (
            health_stream(readings, "event_time", "5 seconds")
            .writeStream.format("parquet")
            .option("checkpointLocation", f"{out}/checkpoint")
            .trigger(**CATCH_UP)
            .start(f"{out}/gold")
        )


@_query
def stream_gold_event_time(spark, sf_dir):
    """The event-time variant: five seconds of watermark over the stored silver stream."""
    house = demo.lakehouse(spark, sf_dir)
    out = shared_dir(spark, "event-time")
    ticks = house.silver.read().agg((F.max("event_time") + F.expr("INTERVAL 1 HOUR")).alias("event_time"))
    ticks.coalesce(1).write.parquet(f"{out}/ticks")
    clock = spark.readStream.schema("event_time TIMESTAMP_NTZ").parquet(f"{out}/ticks")
    readings = house.silver.stream().unionByName(clock.withColumn("is_tick", F.lit(True)), allowMissingColumns=True)
    finish([_windows_to_files(readings, out)])
    return _steady(spark.read.schema(schemas.GOLD).parquet(f"{out}/gold"))


@_query
def late_readings(spark, sf_dir):
    """Event-time windows when the older readings come after the newer ones: windows long closed stay as they were."""
    out = shared_dir(spark, "late")
    rows = _silver(spark, sf_dir)
    newer = F.col("event_time") >= naive(bindings.CUT)

    def run():
        return _windows_to_files(spark.readStream.schema(schemas.SILVER).parquet(f"{out}/in/*"), out)

    rows.where(newer).write.parquet(f"{out}/in/1")
    finish([run()])
    rows.where(~newer).write.parquet(f"{out}/in/2")
    tick = rows.agg((F.max("event_time") + F.expr("INTERVAL 1 HOUR")).alias("event_time"))
    tick = spark.createDataFrame([], schemas.SILVER).unionByName(tick, allowMissingColumns=True)
    tick.coalesce(1).write.parquet(f"{out}/in/3")
    finish([run()])
    return _steady(spark.read.schema(schemas.GOLD).parquet(f"{out}/gold"))


@_query
def stream_gold_arrival(spark, sf_dir):
    """Windows over arrival by the clock, of one second: what must hold whenever the job ran, by device."""
    house = Lakehouse(spark, shared_dir(spark, "arrival"))
    _silver(spark, sf_dir).write.parquet(f"{house.root}/inbox/1")
    arriving = spark.readStream.schema(schemas.SILVER).parquet(f"{house.root}/inbox/*")
    finish([house.silver.append(arriving, CATCH_UP)])
    landed = house.silver.read().count()
    query = house.start_health({"processingTime": "500 milliseconds"}, "arrival", size="1 second")
    try:
        closed = 0
        while closed < landed:
            time.sleep(1)
            active = query.isActive  # asked first, so that what a stream closed before it ended is counted
            closed = house.gold.read().agg(F.sum("cnt_points")).first()[0] or 0
            if closed < landed and not active:
                raise query.exception() or RuntimeError(f"the stream stopped with {closed} of {landed} readings closed")
    finally:
        query.stop()
    gold = house.gold.read()
    over = (F.col("window_end") - F.col("window_start")) != F.expr("INTERVAL 1 SECOND")
    return gold.groupBy("device_id").agg(
        F.sum("cnt_points").alias("points"), F.sum("cnt_anomalies").alias("anomalies"),
        F.sum("cnt_vib_spikes").alias("spikes"), F.max("max_temperature").alias("max_temperature"),
        F.max("anomaly_flag").alias("anomaly_flag"),
        (F.count(F.lit(1)) - F.count_distinct("window_start")).alias("doubled"), F.count_if(over).alias("not_a_second"),
    )


@_query
def landing_quarantine(spark, sf_dir):
    """Two drops of spoiled messages through both sinks, the jobs restarted between them: where each ended up."""
    house = Lakehouse(spark, shared_dir(spark, "quarantine"))
    inbox = f"{house.root}/inbox"
    mangled = _mangled(spark, sf_dir).where("value IS NOT NULL")
    events = bindings.as_messages(bindings.iot_events(spark, sf_dir))
    for drop, part in ((1, "message_id % 3 = 0"), (2, "message_id % 3 <> 0")):
        mangled.where(part).select("value").write.text(f"{inbox}/telemetry/{drop}")
        if drop == 1:
            events.write.text(f"{inbox}/events/{drop}")
        finish(house.start_landing(
            messages.from_folder(spark, f"{inbox}/telemetry/*"), messages.from_folder(spark, f"{inbox}/events/*"), CATCH_UP
        ))
    landed = house.telemetry.read().agg(F.lit("landed").alias("outcome"), F.count(F.lit(1)).alias("messages"))
    aside = house.quarantined(house.telemetry).groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("messages"))
    other = house.events.read().agg(F.lit("events").alias("outcome"), F.count(F.lit(1)).alias("messages"))
    return landed.unionByName(aside).unionByName(other)


# ---- operational queries over whole batch tables ----


@_query
def anomaly_feed(spark, sf_dir):
    return analytics.anomaly_feed(_silver(spark, sf_dir))


@_query
def hot_devices(spark, sf_dir):
    return analytics.hot_devices(_silver(spark, sf_dir))


@_query
def lag_histogram(spark, sf_dir):
    rows = _silver(spark, sf_dir)
    return analytics.lag_histogram(rows, _newest(bindings.events_table(spark, sf_dir), "ts"), "1 DAY")


@_query
def filter_hot_readings(spark, sf_dir):
    return analytics.hotter_than(bindings.telemetry(spark, sf_dir), 29.0)


@_query
def pct_over_threshold(spark, sf_dir):
    return analytics.pct_over_threshold(_gold(spark, sf_dir))


@_query
def event_counts(spark, sf_dir):
    return analytics.event_counts(bindings.iot_events(spark, sf_dir))


@_query
def failure_context(spark, sf_dir):
    return analytics.failure_context(bindings.iot_events(spark, sf_dir), _gold(spark, sf_dir))


@_query
def failure_context_all(spark, sf_dir):
    """Every failure in the context of its hour, without the top-k."""
    hourly = _gold(spark, sf_dir, "1 hour")
    return analytics.failures_in_context(bindings.iot_events(spark, sf_dir), hourly, "1 hour")


@_query
def recent_windows(spark, sf_dir):
    gold = demo.lakehouse(spark, sf_dir).gold.read()
    return _steady(analytics.recent_windows(gold, _newest(gold, "window_start"), "120 MINUTE"))


# ---- quality ----


@_query
def contract_telemetry(spark, sf_dir):
    return quality.telemetry_contract(bindings.telemetry(spark, sf_dir))


@_query
def contract_events(spark, sf_dir):
    return quality.event_contract(bindings.iot_events(spark, sf_dir))


@_query
def landing_health(spark, sf_dir):
    house = demo.lakehouse(spark, sf_dir)
    return quality.landing_health(house.silver.read(), house.gold.read())


@_query
def unmatched_devices(spark, sf_dir):
    return quality.unmatched_devices(bindings.telemetry(spark, sf_dir), bindings.device_seed(spark))


@_query
def type_mix(spark, sf_dir):
    return quality.type_mix(bindings.iot_events(spark, sf_dir))


@_query
def rate_profile(spark, sf_dir):
    return quality.rate_profile(_silver(spark, sf_dir))


# ---- the two tiers ----


@_query
def union_read(spark, sf_dir):
    """Hot and cold rows of silver, each with the tier it came from."""
    return demo.lakehouse(spark, sf_dir).silver.read(tagged=True).withColumnRenamed("_tier", "tier")


@_query
def cold_read(spark, sf_dir):
    return demo.lakehouse(spark, sf_dir).silver.read("cold")


@_query
def cold_count(spark, sf_dir):
    """The cold count as another engine gets it: from the lake's files, with no hot log in the path."""
    lake = Lake(spark, demo.lakehouse(spark, sf_dir).root)
    return analytics.row_count(lake.read(schemas.DEVICE_TELEMETRY.name), "cold_only")


@_query
def live_count(spark, sf_dir):
    """The running count of silver once it has caught up."""
    view = "live_count_" + str(abs(hash(sf_dir)))
    finish([live.running_count(demo.lakehouse(spark, sf_dir).silver.stream(), "hot_plus_cold", view, CATCH_UP)])
    return spark.table(view)


@_query
def live_feed(spark, sf_dir):
    """The anomaly feed as a stream wrote it."""
    out = shared_dir(spark, "feed")
    rows = demo.lakehouse(spark, sf_dir).silver.stream()
    finish([live.feed(rows, f"{out}/rows", f"{out}/checkpoint", CATCH_UP)])
    return spark.read.parquet(f"{out}/rows")


@_query
def lake_snapshots(spark, sf_dir):
    frames = [
        table.snapshots().select(F.lit(name).alias("table_name"), "snapshot_id", "operation", "row_count")
        for name, table in demo.lakehouse(spark, sf_dir).tables.items()
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])


@_query
def freshness_gap(spark, sf_dir):
    return analytics.freshness_gap(demo.lakehouse(spark, sf_dir).silver.read(tagged=True))


@_query
def freshness_gap_gold(spark, sf_dir):
    gap = analytics.freshness_gap(demo.lakehouse(spark, sf_dir).gold.read(tagged=True))
    return gap.select(
        F.col("hot_plus_cold").alias("windows_hot_plus_cold"), F.col("cold_only").alias("windows_cold_only")
    )


@_query
def only_in_hot(spark, sf_dir):
    table = demo.lakehouse(spark, sf_dir).silver
    version = table.pin()
    return analytics.only_in_hot(table.read("hot", version), table.read("cold", version))


@_query
def tiered_hot_devices(spark, sf_dir):
    return analytics.hot_devices(demo.lakehouse(spark, sf_dir).silver.read())


@_query
def tiered_since(spark, sf_dir):
    """A union read from a time on, which skips the cold snapshots that are older."""
    table = demo.lakehouse(spark, sf_dir).silver
    return table.read(since=bindings.CUT - dt.timedelta(days=2)).select("reading_id", "device_id", "event_time")


@_query
def lake_pct_over_threshold(spark, sf_dir):
    lake = Lake(spark, demo.lakehouse(spark, sf_dir).root)
    return analytics.pct_over_threshold(lake.read(schemas.DEVICE_HEALTH.name))


@_query
def lake_event_counts(spark, sf_dir):
    lake = Lake(spark, demo.lakehouse(spark, sf_dir).root)
    return analytics.event_counts(lake.read(schemas.IOT_EVENTS.name))


@_query
def lake_failure_context(spark, sf_dir):
    lake = Lake(spark, demo.lakehouse(spark, sf_dir).root)
    return analytics.failures_in_context(
        lake.read(schemas.IOT_EVENTS.name), lake.read(schemas.DEVICE_HEALTH.name)
    )


@_query
def lake_lag(spark, sf_dir):
    """How far each table's cold tier trails it."""
    frames = [maintenance.lake_lag(table) for table in demo.lakehouse(spark, sf_dir).tables.values()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])


def _week(n: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=7 * n)


@_query
def tiering_flush(spark, sf_dir):
    """Cold rows with the snapshot that brought them, after a flush per drop."""
    staged = demo.staged_table(spark, sf_dir, [_week(2), _week(3)])
    for _ in range(3):
        staged.land().flush()
    table = staged.table
    frames = [
        spark.read.schema(table.spec.schema).parquet(f"{table.data}/snapshot_id={k}")
        .select(F.lit(k).cast("bigint").alias("snapshot_id"), "reading_id", "device_id", "temperature")
        for k in table.pin().snapshots
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@_query
def tiering_catchup(spark, sf_dir):
    """The gap, round by round, while tiering is paused and once it resumes."""
    staged = demo.staged_table(spark, sf_dir, [_week(1), _week(2), _week(3)])
    monitor = FreshnessMonitor(spark, f"{staged.root}/gap")
    monitor.sample(staged.land().table)
    monitor.sample(staged.flush().table)
    for _ in range(3):
        monitor.sample(staged.land().table)
    monitor.sample(staged.flush().table)
    return monitor.samples().drop("as_of")


@_query
def log_ttl(spark, sf_dir):
    """Hot plus cold after the flushed part of the hot log has aged out, streamed and read."""
    staged = demo.staged_table(spark, sf_dir, [_week(2)]).land().flush()
    maintenance.purge(staged.table, older_than_s=0)
    table = staged.land().table
    out = shared_dir(spark, "after-ttl")
    query = (
        table.stream()
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(**CATCH_UP)
        .start(f"{out}/rows")
    )
    finish([query])
    streamed = spark.read.schema(table.spec.schema).parquet(f"{out}/rows")
    return table.read(tagged=True).select("_tier", "reading_id").withColumnRenamed("_tier", "source").unionByName(
        streamed.select(F.lit("stream").alias("source"), "reading_id")
    )


@_query
def stream_after_ttl(spark, sf_dir):
    """A standing reader that begins after a purge and is restarted after another: every reading once."""
    staged = demo.staged_table(spark, sf_dir, [_week(1), _week(2), _week(3)])
    table, out = staged.land().flush().table, shared_dir(spark, "standing")

    def run():
        return (
            table.stream("standing", f"{out}/checkpoint")
            .writeStream.format("parquet")
            .option("checkpointLocation", f"{out}/checkpoint")
            .trigger(**CATCH_UP)
            .start(f"{out}/rows")
        )

    maintenance.purge(table, older_than_s=0)
    staged.land()
    finish([run()])
    staged.flush().land().flush()
    maintenance.purge(table, older_than_s=0)  # takes the second drop, which was read, and leaves the third
    staged.land()
    finish([run()])
    rows = spark.read.schema(table.spec.schema).parquet(f"{out}/rows")
    return rows.select("reading_id", "device_id", "event_time", "temperature")


@_query
def silver_after_ttl(spark, sf_dir):
    """Silver when bronze was flushed and purged before enrichment first ran."""
    house = Lakehouse(spark, shared_dir(spark, "late-start"))
    house.dimension.seed()
    bindings.telemetry(spark, sf_dir).write.parquet(f"{house.root}/inbox/1")
    arriving = spark.readStream.schema(schemas.TELEMETRY).parquet(f"{house.root}/inbox/*")
    finish([house.telemetry.append(arriving, CATCH_UP)])
    finish([house.telemetry.flush(CATCH_UP)])
    maintenance.purge(house.telemetry, older_than_s=0)
    finish([house.start_enrichment(CATCH_UP, bindings.arrival())])
    return house.silver.read()


@_query
def flush_lag(spark, sf_dir):
    """Every flush of a table against a target none can meet, one none can miss and its own, expired snapshots included."""
    staged = demo.staged_table(spark, sf_dir, [_week(2), _week(3)])
    for _ in range(3):
        staged.land().flush()
    maintenance.compact(staged.table)
    maintenance.expire(staged.table, older_than_s=0)
    at_once, in_a_day = (
        maintenance.flush_intervals(staged.table, freshness).select("snapshot_id", F.col("missed_target").alias(name))
        for freshness, name in (("0 seconds", "missed_at_once"), ("1 day", "missed_in_a_day"))
    )
    flushes = maintenance.flush_intervals(staged.table).select(
        "snapshot_id", "row_count", "target_s", F.col("interval_s").isNotNull().alias("has_interval")
    )
    return flushes.join(at_once, "snapshot_id").join(in_a_day, "snapshot_id")


@_query
def peek_hot(spark, sf_dir):
    """A few of the hot readings, whichever they are: how many there were, and whether all are among the rest."""
    hot = analytics.hotter_than(bindings.telemetry(spark, sf_dir), 29.0)
    few = analytics.peek(hot).select("reading_id").withColumn("looked", F.lit(1))
    both = hot.select("reading_id").join(few, "reading_id", "full")
    return both.agg(F.sum("looked").alias("rows"), F.count(F.lit(1)).alias("hot_readings"))


@_query
def compaction(spark, sf_dir):
    """Hot plus cold after the flushes were rewritten as one snapshot and expired."""
    staged = demo.staged_table(spark, sf_dir, [_week(1), _week(2), _week(3)])
    for _ in range(3):
        staged.land().flush()
    maintenance.compact(staged.table)
    maintenance.expire(staged.table, older_than_s=0)
    staged.land()
    live_snapshots = staged.table.live().count()
    rows = staged.table.read(tagged=True).withColumnRenamed("_tier", "tier")
    return rows.select("tier", "reading_id", "device_id", "event_time", "temperature").withColumn(
        "live_snapshots", F.lit(live_snapshots).cast("bigint")
    )



# ---- state and changes ----


def _drops(rows: DataFrame, by: str, folder: str):
    """The rows before the cut, then the others, each written as a drop of its own once it is asked for."""
    before = F.col(by) < naive(bindings.CUT)
    for number, part in ((1, before), (2, ~F.coalesce(before, F.lit(False)))):
        rows.where(part).write.parquet(f"{folder}/{number}")
        yield number


def _to_files(rows: DataFrame, out: str, trigger: dict = CATCH_UP):
    """A stream's new rows appended to ``out``/rows."""
    with uncounted_state(rows.sparkSession):
        return (
            rows.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint").trigger(**trigger).start(f"{out}/rows")
        )


@_query
def stream_lookup_per_reading(spark, sf_dir):
    """Readings and device changes as two streams: each reading gets the change before it, in the same micro-batch too."""
    out = shared_dir(spark, "per-reading")
    changes = bindings.device_changes(spark, sf_dir)
    versions = changes.groupBy("device_id", "valid_from").agg(F.max(F.struct(*DIM_COLUMNS)).alias("v"))
    versions = versions.select("device_id", F.col("valid_from").alias("event_time"), "valid_from", "v.*")
    readings = bindings.telemetry(spark, sf_dir).select("reading_id", "device_id", "event_time", "temperature")
    found = None
    for _ in zip(_drops(readings, "event_time", f"{out}/readings"), _drops(versions, "event_time", f"{out}/changes")):
        arriving = [
            spark.readStream.schema(rows.schema).parquet(f"{out}/{name}/*")
            for name, rows in (("readings", readings), ("changes", versions))
        ]
        found = stateful.lookup_per_reading(*arriving, "event_time", ["valid_from", *DIM_COLUMNS])
        finish([_to_files(found, out)])
    return spark.read.schema(found.schema).parquet(f"{out}/rows")


@_query
def late_side_output(spark, sf_dir):
    """Readings in event-time windows, and those that came after their window had closed: by device and window.

    Odd readings of every day come after the even ones of the days before the cut.
    """
    out = shared_dir(spark, "late-aside")
    rows = _silver(spark, sf_dir)
    first = (F.col("event_time") < naive(bindings.CUT)) & (F.col("reading_id") % 2 == 0)

    def tell():
        arriving = spark.readStream.schema(schemas.SILVER).parquet(f"{out}/in/*")
        finish([_to_files(stateful.tell_late(arriving, "event_time", "5 seconds"), out)])

    def windows():
        told = spark.readStream.schema(f"{_ddl(schemas.SILVER)}, late BOOLEAN").parquet(f"{out}/rows").where("NOT late").drop("late")
        clock = spark.readStream.schema("event_time TIMESTAMP_NTZ").parquet(f"{out}/ticks").withColumn("is_tick", F.lit(True))
        finish([_to_files(
            health_stream(told.unionByName(clock, allowMissingColumns=True), "event_time", "5 seconds"), f"{out}/windows"
        )])

    spark.createDataFrame([], "event_time TIMESTAMP_NTZ").write.parquet(f"{out}/ticks")
    rows.where(first).write.parquet(f"{out}/in/1")
    tell()
    windows()
    rows.where(~first).write.parquet(f"{out}/in/2")
    tell()
    windows()
    tick = rows.agg((F.max("event_time") + F.expr("INTERVAL 1 HOUR")).alias("event_time"))
    tick.coalesce(1).write.mode("append").parquet(f"{out}/ticks")
    windows()
    told = spark.read.schema(f"{_ddl(schemas.SILVER)}, late BOOLEAN").parquet(f"{out}/rows")
    start = F.window("event_time", "1 minute")["start"].cast("timestamp_ntz").alias("window_start")
    late = told.where("late").select("device_id", start, F.lit(0).alias("in_window"), F.lit(1).alias("late"))
    closed = spark.read.schema(schemas.GOLD).parquet(f"{out}/windows/rows").select(
        "device_id", "window_start", F.col("cnt_points").alias("in_window"), F.lit(0).alias("late")
    )
    return closed.unionByName(late).groupBy("device_id", "window_start").agg(
        F.sum("in_window").alias("in_window"), F.sum("late").alias("late")
    )


def _ddl(schema) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)


@_query
def dim_changelog(spark, sf_dir):
    """What the seed and two upserts changed in the dimension, version by version."""
    dim = DeviceDimension(spark, shared_dir(spark, "changelog"), slices=4)
    dim.seed()
    changes = bindings.device_changes(spark, sf_dir)
    for part in (F.col("valid_from") < naive(bindings.CUT), F.col("valid_from") >= naive(bindings.CUT)):
        dim.upsert(changes.where(part), ["valid_from", "temp_threshold", "model", "location_id"])
    return dim.changelog()


@_query
def only_in_hot_exact(spark, sf_dir):
    """Rows of the whole table that the lake lacks, with copies, where every id is shared by many rows."""
    house = demo.lakehouse(spark, sf_dir)
    columns = [F.pmod("reading_id", F.lit(50)).alias("reading_id"), "device_id", F.round("temperature").alias("temperature"), "anomaly_flag"]
    union = house.silver.read().select(*columns)
    cold = Lake(spark, house.root).read(schemas.DEVICE_TELEMETRY.name).select(*columns)
    return analytics.only_in_hot_exact(union, cold)


@_query
def live_failure_context(spark, sf_dir):
    """Failures and hourly windows as two streams, joined as either side lands."""
    out = shared_dir(spark, "live-context")
    events, gold = bindings.iot_events(spark, sf_dir), _gold(spark, sf_dir, "1 hour")
    found = None
    for _ in zip(_drops(events, "event_time", f"{out}/events"), _drops(gold, "window_start", f"{out}/gold")):
        found = live.failures_in_context(
            spark.readStream.schema(schemas.EVENTS).parquet(f"{out}/events/*"),
            spark.readStream.schema(schemas.GOLD).parquet(f"{out}/gold/*"), "1 hour",
        )
        finish([_to_files(found, out)])
    return spark.read.schema(found.schema).parquet(f"{out}/rows")


@_query
def live_hot_devices(spark, sf_dir):
    """The five hottest devices after each of two drops."""
    out = shared_dir(spark, "ranking")
    rows, after = _silver(spark, sf_dir), []
    ranking = live.HotRanking(spark, f"{out}/ranking", f"{out}/checkpoint", k=5)
    for drop in _drops(rows, "event_time", f"{out}/in"):
        arriving = spark.readStream.schema(schemas.SILVER).parquet(f"{out}/in/*")
        finish([ranking.start(arriving, CATCH_UP)])
        after.append(ranking.current().withColumn("after_drop", F.lit(drop)))
    return after[0].unionByName(after[1])


@_query
def live_lag_histogram(spark, sf_dir):
    """The lag histogram of the last minute at every twenty seconds, as a stream emits it."""
    out = shared_dir(spark, "live-lag")
    rows = _silver(spark, sf_dir)
    tick = rows.agg((F.max("event_time") + F.expr("INTERVAL 1 HOUR")).alias("event_time"))
    tick = spark.createDataFrame([], schemas.SILVER).unionByName(tick, allowMissingColumns=True)
    found = None
    for drop in _drops(rows, "event_time", f"{out}/in"):
        if drop == 2:
            tick.coalesce(1).write.mode("append").parquet(f"{out}/in/2")
        found = live.lag_histograms(spark.readStream.schema(schemas.SILVER).parquet(f"{out}/in/*"), "20 seconds")
        finish([_to_files(found, out)])
    return spark.read.schema(found.schema).parquet(f"{out}/rows")


@_query
def type_mix_fit(spark, sf_dir):
    """How far the mix of event types is from the expected one."""
    return quality.type_mix_fit(bindings.iot_events(spark, sf_dir)).withColumns(
        {"chi_square": F.round("chi_square", 6), "p_value": F.round("p_value", 9)}
    )


@_query
def rate_fit(spark, sf_dir):
    """How far anomalies and spikes are from what their thresholds lead to expect."""
    places = {"expected": 9, "deviations": 6, "p_value": 9}
    return quality.rate_fit(_silver(spark, sf_dir)).withColumns({c: F.round(c, n) for c, n in places.items()})


@_query
def stream_health(spark, sf_dir):
    """Two micro-batches of an enrichment job as a listener saw them; the second has lost every timestamp."""
    house = Lakehouse(spark, shared_dir(spark, "health"))
    house.dimension.seed()
    seen = watch.LandingHealth(spark, f"{house.root}/landing-health")
    spark.streams.addListener(seen)
    try:
        rows = bindings.telemetry(spark, sf_dir)
        lost = F.when(F.col("event_time") < naive(bindings.CUT), F.col("event_time"))
        for drop in _drops(rows, "event_time", f"{house.root}/in"):
            landed = spark.readStream.schema(schemas.TELEMETRY).parquet(f"{house.root}/in/{{{','.join(map(str, range(1, drop + 1)))}}}")
            finish([house.telemetry.append(landed.withColumn("event_time", lost), CATCH_UP)])
            finish([house.start_enrichment(CATCH_UP)])
            seen.wait(drop)
    finally:
        spark.streams.removeListener(seen)
    return seen.rows().drop("query", "seen_at")
