"""Structured Streaming forms of the ingest and the daily roll-up.

* T1 ``merge_observations``: the first arrival of a (station, obs_ts) key wins.
  Arrival is the message's own sequence if it has one, else the landing time of
  its file, then the file name and the reading's epoch: a total order that does
  not depend on how files are cut into batches. A batch appends the keys that
  are not stored yet; stored files stay as they are. Only if a batch holds an
  earlier arrival of a stored key (files read out of order) are the days of
  those keys rewritten. A replayed batch changes nothing.
* Messages that cannot be parsed, and readings outside their column's range, go
  to a reject table beside the observations, one folder per batch.
* T2/T5 ``refresh_daily``: the days a batch touched are recomputed from the
  stored observations (including the daylight solar mean) and appended as change
  files of the daily table, which a compaction takes in now and then. Late rows
  simply re-touch their day, which is also the T4 backfill path.
* T3 ``finalized_daily``: pure streaming aggregations in append mode, the first
  arrival per key and then the day, emitted once the watermark passes its end.

Stored tables are read in the partitions that the batch has rows in, named by literals. Intermediate results are written under ``spark.checkpoint.dir``
first, so a job never reads the files it replaces, and deleted after the batch.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.changes import compact, write_changes
from ..operators.ingest import flatten_observations, out_of_range
from ..operators.rollup import daily_rollup, day_aggregates, solar_aggregate, sun_of_days, with_daylight
from ..operators.upsert import append_rows, first_arrival, in_partitions, write_partitions
from ..session import Scratch, read_parquet_if_exists

OBS_KEYS = ["station", "obs_ts"]
ARRIVAL = ["arrival", "landed_file", "epoch"]
# Directory partitions are dates only: with many stations, (station, day)
# directories would mean millions of tiny files. Rows are clustered by station
# inside each partition so parquet min/max statistics still prune by station.
OBS_PARTS = ["obs_date"]
DAILY_PARTS = ["year", "month"]
COMPACT_EVERY = 32      # micro-batches whose daily rows are change files

# Landed message envelope: the feed message, with an arrival sequence if the
# landing job adds one, and the text of lines that do not parse.
LANDED_MESSAGE = T.StructType(list(schemas.OBS_MESSAGE.fields) + [
    T.StructField("arrival", T.LongType(), True), T.StructField("_corrupt", T.StringType(), True)])


def read_landed(spark: SparkSession, landing: str, files_per_trigger: int | None = None) -> DataFrame:
    """The landed messages with a total arrival order."""
    r = spark.readStream.schema(LANDED_MESSAGE).option("columnNameOfCorruptRecord", "_corrupt")
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.json(landing).select(
        "observations", F.coalesce("arrival", F.unix_micros("_metadata.file_modification_time")).alias("arrival"),
        F.col("_metadata.file_name").alias("landed_file"), "_corrupt")


def merge_observations(batch: DataFrame, target_path: str, scratch: Scratch) -> DataFrame:
    """T1 micro-batch: unseen keys are appended, earlier arrivals replace stored ones.

    Returns the (station, date) pairs the batch touched.
    """
    spark = batch.sparkSession
    b = scratch.table(first_arrival(batch, OBS_KEYS, ARRIVAL).withColumn("obs_date", F.to_date("obs_ts")), "obs-batch")
    target = read_parquet_if_exists(spark, target_path)
    if target is None:  # first batch: no table yet
        write_partitions(b, target_path, OBS_PARTS, OBS_KEYS)
        return b.select("station", F.col("obs_date").alias("date")).distinct()
    near = in_partitions(target, b, OBS_PARTS)
    order = F.struct(*ARRIVAL)
    stored = near.select(*OBS_PARTS, *OBS_KEYS, order.alias("_stored"))
    seen = scratch.table(b.join(stored, OBS_PARTS + OBS_KEYS, "left"), "obs-seen")
    touched = seen.filter(F.col("_stored").isNull() | (order < F.col("_stored"))) \
        .select("station", F.col("obs_date").alias("date")).distinct()
    new = seen.filter("_stored IS NULL").drop("_stored")
    earlier = seen.filter(order < F.col("_stored")).drop("_stored")
    n_new, n_earlier = seen.agg(F.count_if(F.col("_stored").isNull()), F.count_if(order < F.col("_stored"))).first()
    if n_earlier:
        days = earlier.select(*OBS_PARTS).distinct()
        rewritten = near.join(days, OBS_PARTS, "left_semi").unionByName(
            b.join(days, OBS_PARTS, "left_semi").select(*near.columns))
        merged = scratch.table(first_arrival(rewritten, OBS_KEYS, ARRIVAL), "obs-merge")
        new = new.join(days, OBS_PARTS, "left_anti")
        write_partitions(merged, target_path, OBS_PARTS, OBS_KEYS)
    if n_new:
        append_rows(new.select(*target.columns), target_path, OBS_PARTS, OBS_KEYS)
    return touched


def with_months(daily: DataFrame) -> DataFrame:
    return daily.withColumn("year", F.year("date")).withColumn("month", F.month("date"))


def refresh_daily(spark: SparkSession, touched: DataFrame, obs_path: str, daily_path: str,
                  stations: DataFrame | None, batch: str) -> None:
    """Recompute the touched days from stored observations and write them as a change batch."""
    # the sun times of the touched days only
    sun = None if stations is None else sun_of_days(touched, stations)
    touched = touched.withColumnRenamed("date", "obs_date")
    obs = in_partitions(spark.read.parquet(obs_path), touched, OBS_PARTS)
    cut = obs.join(touched, ["station", "obs_date"], "left_semi")
    days = with_months(daily_rollup(cut.drop("obs_date", *ARRIVAL), sun=sun))
    write_changes(daily_path, days, schemas.DAILY_KEYS, DAILY_PARTS, batch=batch)


def observation_rows(msgs: DataFrame, wind_factor: float = 1.5) -> DataFrame:
    """Landed messages -> observation rows with their arrival (empty messages dropped)."""
    return flatten_observations(msgs, wind_factor, keep=["arrival", "landed_file"])


def rejected_path(obs_path: str) -> str:
    return obs_path.rstrip("/") + "_rejected"


def run_ingest(spark: SparkSession, landing: str, obs_path: str, checkpoint: str,
               daily_path: str | None = None, stations: DataFrame | None = None,
               files_per_trigger: int | None = None, available_now: bool = True,
               compact_every: int = COMPACT_EVERY):
    """Start T1 (and T2 when ``daily_path`` is given) over landed message files.

    The daily rows are change batches beside ``daily_path`` (``changes.read_merged`` gives the table);
    every ``compact_every`` batches they are taken into it.
    """
    writer = zlib.crc32(checkpoint.encode())
    msgs = read_landed(spark, landing, files_per_trigger)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        with Scratch(session) as scratch:
            # judged once, while the messages are parsed; the later filters skip by the column's statistics
            reason = F.when(F.col("_corrupt").isNotNull(), "not parsed").when(out_of_range(), "out of range")
            batch = scratch.table(batch.withColumn("reason", reason), "messages")
            bad = batch.filter("reason IS NOT NULL")
            if bad.limit(1).count():
                bad.write.mode("overwrite").parquet(f"{rejected_path(obs_path)}/batch={epoch_id}")
            rows = observation_rows(batch.filter("reason IS NULL"))
            if not rows.limit(1).count():
                return
            touched = merge_observations(rows, obs_path, scratch)
            if daily_path is None:
                return
            touched = scratch.table(touched, "touched")
            if touched.limit(1).count():
                refresh_daily(session, touched, obs_path, daily_path, stations, f"{writer:08x}-{epoch_id}")
            if epoch_id % compact_every == compact_every - 1:
                compact(session, daily_path, schemas.DAILY_KEYS, DAILY_PARTS)

    w = msgs.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def finalized_daily(obs_stream: DataFrame, watermark: str = "2 days",
                    sun: DataFrame | None = None) -> DataFrame:
    """Day rows emitted once the watermark passes the end of the day.

    Two chained aggregations: the first keeps the earliest arrival of every (station, obs_ts), as T1
    does, and passes it on once the watermark is beyond it; the second rolls the day up. What comes
    later than the watermark is dropped. The local wall clock is carried as the instant at which a
    UTC clock shows it, by plain arithmetic, so the session's time zone plays no part. With
    ``sun``, a static table of :func:`isobar.operators.rollup.sun_times`, the daylight solar mean is given.
    """
    order = [c for c in ARRIVAL if c in obs_stream.columns]
    if not order:
        raise ValueError(f"first arrivals need one of the columns: {', '.join(ARRIVAL)}")
    zero = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    instant = F.timestamp_seconds(F.timestamp_diff("SECOND", zero, F.col("obs_ts")))
    values = F.struct(*[c for c in obs_stream.columns if c not in OBS_KEYS])
    first = obs_stream.withColumn("event_time", instant).withWatermark("event_time", watermark) \
        .groupBy(*OBS_KEYS, F.window("event_time", "1 second").alias("k")) \
        .agg(F.min_by(values, F.struct(*order)).alias("r")) \
        .select(*OBS_KEYS, F.window_time("k").alias("event_time"), "r.*")
    rows = first if sun is None else with_daylight(first, sun)
    agg = rows.groupBy("station", F.window("event_time", "1 day").alias("w")) \
        .agg(*day_aggregates(), solar_aggregate(sun is not None))
    date = F.date_add(F.lit("1970-01-01").cast("date"), F.expr("CAST(unix_seconds(w.start) div 86400 AS INT)"))
    return agg.select("station", date.alias("date"), *schemas.DAILY_MEASURES)
