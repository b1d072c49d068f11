"""Stream jobs over machine telemetry.

The jobs run the batch operators on each micro-batch, so a busy machine is spread over tasks
here too. What has to be kept between batches lies in the shared folder, under the number of the
batch that wrote it; a batch that is run again writes the same again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from plantpulse.operators.ordered import TimeOrder, carry, with_previous
from plantpulse.plans.alarms import BY_ALARM, COLUMNS, lines_of_changes
from plantpulse.session import discard, stored
from plantpulse.sources.sinks import write_by

_BY_MACHINE = TimeOrder(keys=["serial"])
# Folders that each delivery of alarm rows is stored in.
SLOTS = 64


def read_stream(
    spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    """New Parquet files of a folder; all that are there make one micro-batch, unless a number is given."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def on_disk(spark: SparkSession) -> SparkSession:
    """Keep the state of stateful queries in the disk-backed store, as days of ids don't fit into memory."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return spark


def each_batch(df: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run ``step`` on every micro-batch of the data available now."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(step).trigger(availableNow=True).start()


def drop_repeats(df: DataFrame, key: str = "uuid", time: str = "time", late: str = "10 days") -> DataFrame:
    """Rows whose id was not delivered before, within the time late rows may take."""
    zoned = df.withColumn(time, F.col(time).cast("timestamp"))
    unique = zoned.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
    return unique.withColumn(time, F.col(time).cast("timestamp_ntz"))


def last_known_state(df: DataFrame, state: str = "program_state", key: str = "serial") -> DataFrame:
    """Last known state per machine, as an aggregate that is combined before the shuffle."""
    known = df.where(F.col(state).isNotNull())
    return known.groupBy(key).agg(F.max(F.struct("time", "uuid", state)).alias("_last")).select(
        key, F.col("_last.time").alias("time"), F.col(f"_last.{state}").alias(state))


def store_updates(folder: str) -> Callable[[DataFrame, int], None]:
    """Write the changed rows of an update-mode aggregate under their batch number."""

    def step(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/run={number}")

    return step


def latest_updates(spark: SparkSession, folder: str, key: str) -> DataFrame:
    """The newest row of each key among the stored updates."""
    updates = spark.read.parquet(folder)
    columns = [c for c in updates.columns if c not in (key, "run")]
    newest = updates.groupBy(key).agg(F.max_by(F.struct(*columns), "run").alias("_row"))
    return newest.select(key, "_row.*")


def compact_updates(spark: SparkSession, folder: str, key: str) -> None:
    """Replace the stored updates by the newest row of each key.

    The rows take the number of the newest batch. To be run between two runs of the job.
    """
    updates = spark.read.parquet(folder)
    last = updates.agg(F.max("run")).first()[0]
    rows, kept = stored(latest_updates(spark, folder, key), "compacted")
    old = [r["run"] for r in updates.select("run").distinct().collect() if r["run"] != last]
    rows.write.mode("overwrite").parquet(f"{folder}/run={last}")
    discard(spark, kept, *[f"{folder}/run={n}" for n in old])


def _slot(keys: list[str]) -> Column:
    return F.pmod(F.hash(*keys), F.lit(SLOTS))


def delivered_rows(spark: SparkSession, folder: str, schema: StructType, number: int, slots: list[int]) -> DataFrame:
    """Rows of some slots of alarms, of all deliveries up to one; the others' files are not read."""
    whole = StructType([*schema.fields, StructField("run", IntegerType()), StructField("slot", IntegerType())])
    rows = spark.read.schema(whole).parquet(folder).where((F.col("run") <= number) & F.col("slot").isin(slots))
    return rows.select(*schema.names)


def alarm_blocks(lines_folder: str, open_folder: str) -> Callable[[DataFrame, int], None]:
    """Emit alarm lines as their blocks close, and hold the rows of the open ones.

    Held are, per alarm, the changes from the last return to zero on, the row before that return, and the
    newest row. A row older than the newest one held of its alarm came too late for that: all lines of this alarm
    are computed again from the rows that were ever delivered, and the alarm is noted as repaired. Rows are stored in
    slots of alarms for this, and of earlier deliveries only the slots of such alarms are read; without one nothing is. Read the
    lines with ``current_lines``.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        keys = ["serial", "idx"]
        history, made = f"{lines_folder}-rows", []
        delivered = batch.select(*COLUMNS)
        write_by(delivered.withColumn("slot", _slot(keys)), f"{history}/run={number}", "slot", replace=True)
        new = spark.read.schema(delivered.schema).parquet(f"{history}/run={number}")
        rows, late = new, None
        if number > 0:
            held = spark.read.schema(new.schema).parquet(f"{open_folder}/run={number - 1}")
            newest = held.groupBy(*keys).agg(F.max(BY_ALARM.position()).alias("_newest"))
            came_late = new.join(newest, keys).where(BY_ALARM.position() < F.col("_newest")).select(*keys).distinct()
            late, late_folder = stored(came_late, "alarm-late")
            made.append(late_folder)
            # At most one number for each slot.
            slots = [r["slot"] for r in late.select(_slot(keys).alias("slot")).distinct().collect()]
            rows = new.unionByName(held)
            if slots:
                every = delivered_rows(spark, history, new.schema, number, slots).join(late, keys, "left_semi")
                rows = rows.join(late, keys, "left_anti").unionByName(every)
        # One order over the rows tells the changes, for the lines and for what is held.
        before = with_previous(BY_ALARM.sliced(rows), BY_ALARM, _state="state", _time="time", _uuid="uuid")
        marked, folder = stored(before.withColumn("_changed", F.coalesce(F.col("_state") != F.col("state"), F.lit(False))), "alarm-rows")
        made.append(folder)
        changes = marked.where("_changed").drop("_state", "_time", "_uuid", "_changed")
        lines_of_changes(changes).write.mode("overwrite").parquet(f"{lines_folder}/run={number}")
        if late is not None:
            late.write.mode("overwrite").parquet(f"{lines_folder}-repaired/run={number}")
        _open_rows(marked).write.mode("overwrite").parquet(f"{open_folder}/run={number}")
        discard(spark, *made, *([f"{open_folder}/run={number - 2}"] if number > 1 else []))

    return step


def current_lines(spark: SparkSession, lines_folder: str) -> DataFrame:
    """The alarm lines, of repaired alarms those of the last repair on."""
    lines = spark.read.parquet(lines_folder)
    repaired = f"{lines_folder}-repaired"
    path = spark._jvm.org.apache.hadoop.fs.Path(repaired)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return lines.drop("run")
    schema = StructType([lines.schema["serial"], lines.schema["idx"]]).add("run", "integer")
    last = spark.read.schema(schema).parquet(repaired).groupBy("serial", "idx").agg(F.max("run").alias("_repaired"))
    joined = lines.join(last, ["serial", "idx"], "left")
    return joined.where(F.col("_repaired").isNull() | (F.col("run") >= F.col("_repaired"))).select(*[c for c in lines.columns if c != "run"])


def _open_rows(marked: DataFrame) -> DataFrame:
    """What is held of rows that know the one before them and whether they are a change."""
    at = BY_ALARM.position()
    keys = ["serial", "idx"]
    # The row before the last return to zero makes that return a change again.
    returned = F.max(F.when(F.col("_changed") & (F.col("state") == 0), F.struct(at.alias("at"), F.struct(
        F.col("_time").alias("time"), F.col("_uuid").alias("uuid")).alias("edge"))))
    anchors = marked.groupBy(*keys).agg(
        F.min(at).alias("_first"), F.max(at).alias("_newest"), returned.alias("_returned")).select(
        *keys, F.coalesce("_returned.edge", "_first").alias("_from"), F.col("_returned.at").alias("_zero"), "_newest")
    recent = F.col("_changed") & (F.col("_zero").isNull() | (at >= F.col("_zero")))
    keep = (at == F.col("_from")) | (at == F.col("_newest")) | recent
    return marked.join(anchors, keys).where(keep).select(*COLUMNS)


def late_repair(folder: str, state: str = "program_state") -> Callable[[DataFrame, int], None]:
    """Keep a table with carried states right when rows arrive late.

    The days from the earliest new row on are replaced. Only machines with new rows are computed again, from their last
    known state before these days on; rows of the others are taken over. The table has one folder per day.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new, rows_folder = stored(batch.select("uuid", "time", "serial", state), "late-rows")
        start = F.to_date(new.agg(F.min("time")).scalar())
        rows, others = new, None
        if number > 0:
            schema = new.withColumn("carried", F.lit(0.0)).withColumn("day", F.to_date("time")).schema
            kept_days = spark.read.schema(schema).parquet(folder)
            seeds = _seeds(kept_days.where(F.col("day") < start), state)
            # A batch that is run again finds its own rows stored.
            again = new.select(F.col("serial").alias("_again")).distinct()
            same = F.col("serial").eqNullSafe(F.col("_again"))
            kept = kept_days.where(F.col("day") >= start).join(new.select("uuid"), "uuid", "left_anti")
            others = kept.join(again, same, "left_anti")
            rows = new.unionByName(kept.join(again, same, "left_semi").select(*new.columns)).unionByName(seeds.join(again, same, "left_semi"))
        filled = carry(rows, _BY_MACHINE, carried=state).withColumn("day", F.to_date("time")).where(F.col("day") >= start)
        days, days_folder = stored(filled if others is None else filled.unionByName(others), "late-days")
        write_by(days, folder, "day", replace=True)
        discard(spark, rows_folder, days_folder)

    return step


def _seeds(earlier: DataFrame, state: str) -> DataFrame:
    last = earlier.where(F.col("carried").isNotNull()).groupBy("serial").agg(
        F.max(F.struct("time", "uuid", "carried")).alias("_last"))
    return last.select(
        F.col("_last.uuid").alias("uuid"), F.col("_last.time").alias("time"), "serial",
        F.col("_last.carried").alias(state))
