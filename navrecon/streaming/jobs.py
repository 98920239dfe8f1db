"""Files processed once as they arrive, and log windows kept up to date.

Every batch writes below its own batch number and overwrites that folder, so a
batch repeated after a failure leaves the same result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navrecon.operators import monitor
from navrecon.operators.monitor import merge_parts
from navrecon.plans import flows
from navrecon.sources import files, manifest, mapping, store


def _same(batch: DataFrame) -> DataFrame:
    return batch


def _write_batches(target: str, change: Callable[[DataFrame], DataFrame]):
    def write(batch: DataFrame, number: int) -> None:
        change(batch).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{target}/batch={number}")
    return write


def _run(stream: DataFrame, target: str, checkpoint: str, change: Callable[[DataFrame], DataFrame] = _same) -> None:
    query = (
        stream.writeStream.outputMode("append").foreachBatch(_write_batches(target, change))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


ARRIVED = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def arrivals(spark: SparkSession, incoming: str, files_per_batch: int) -> DataFrame:
    """The paths of CSV and JSON files as they arrive below a folder, each once; no content is read."""
    return (
        spark.readStream.format("binaryFile").schema(ARRIVED).option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.{csv,json}").option("maxFilesPerTrigger", files_per_batch)
        .load(incoming).select("path", "length").where("length > 0"))


def file_of(path: Column) -> Column:
    """The name of an arrived file from its encoded path; of a part of a folder named like a file, the folder's."""
    def decoded(place: int) -> Column:
        return F.url_decode(F.replace(F.element_at(F.split(path, "/"), place), F.lit("+"), F.lit("%2B")))
    return F.when(decoded(-2).rlike("[.](csv|json)$"), decoded(-2)).otherwise(decoded(-1))


def read_arrived(
    spark: SparkSession, paths: list[str], now: Column, settings: flows.LoadSettings, lines: bool,
) -> DataFrame | None:
    """Text rows with audit columns of CSV and JSON files of any vendor, told from their names."""
    out = None
    for suffix in (".csv", ".json"):
        own = [p for p in paths if p.endswith(suffix)]
        if own:
            raw = files.read_vendor_file(spark, own, lines, malformed=flows.MALFORMED, lineage=True)
            text = flows.text_rows(raw, settings, (flows.MALFORMED, "_path")).withColumn("file_name", file_of(F.col("_path")))
            rows = mapping.with_audit(text.drop("_path"), manifest.vendor_of("file_name"), F.col("file_name"), now)
            out = rows if out is None else out.unionByName(rows)
    return out


def ingest_files(
    spark: SparkSession, incoming: str, target: str, checkpoint: str, now: Column, files_per_batch: int = 1000,
    settings: flows.LoadSettings = flows.LoadSettings(), lines: bool = False,
) -> None:
    """Load every CSV and JSON file below `incoming` that earlier runs have not loaded.

    Each batch is a whole load under its number: rejected rows, surplus rows and issues
    are kept, the key holds, running values go on, and every file gets its log row, so
    that stored + rejected + duplicates = rows read. The checkpoint remembers the files;
    a batch repeated after a failure replaces its parts and changes no stored row.
    A batch's list of paths (files_per_batch at most) is what comes to the driver.
    lines: JSON files hold a record per line.
    """
    def load(batch: DataFrame, number: int) -> None:
        # The batch belongs to the stream's own session; its paths are read by that session too.
        session = batch.sparkSession
        rows = read_arrived(session, sorted(r.path for r in batch.collect()), now, settings, lines)
        if rows is not None:
            done = flows.load_rows(session, rows, f"batch-{number:010d}", target, settings)
            store.write_part(flows.file_log(done, now), f"{target}-log", f"batch-{number:010d}")

    query = (
        arrivals(spark, incoming, files_per_batch).writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def log_windows(lines: DataFrame, parts: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> None:
    """Streaming twin of a log-window query: each batch writes the additive parts of the windows it saw.

    There is no state and no watermark, so a line counts however late it comes and in
    whatever order files arrive.
    """
    _run(lines, target, checkpoint, parts)


def merged_windows(
    spark: SparkSession, target: str, finish: Callable[[DataFrame], DataFrame], by: tuple[str, ...] = ()
) -> DataFrame:
    """The windows as of now: the batches' parts added up."""
    return finish(merge_parts(spark.read.parquet(target), by))


def compact_windows(spark: SparkSession, target: str, into: str, by: tuple[str, ...] = ()) -> None:
    """Fold the parts of all batches so far into one set of rows per window."""
    merge_parts(spark.read.parquet(target), by).write.mode("overwrite").parquet(into)


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a folder as a stream."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def closed_windows(
    stream: DataFrame, parts: Callable[[DataFrame], DataFrame], delay: str, target: str, checkpoint: str, ts: str = "ts",
) -> None:
    """The windows of `parts` in append mode: each is written once, when the watermark has passed its end.

    The state holds the windows still open. Rows that come later than `delay` behind the
    latest time seen are not in them; late_counts tells how many there were.
    """
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    _run(parts(timed), target, checkpoint)


def late_counts(spark: SparkSession, all_parts: str, closed: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Closed windows with n, the rows they were closed with, and late, those that came after.

    all_parts are the additive parts that log_windows keeps of the same stream: they hold every row.
    """
    def facts(path: str) -> DataFrame:
        return merge_parts(spark.read.parquet(path).withColumn(
            "window_start", F.col("window_start").cast("timestamp_ntz")), by)

    whole = facts(all_parts).select(*by, "window_start", F.col("n").alias("_all"))
    return facts(closed).join(whole, [*by, "window_start"]).withColumn("late", F.col("_all") - F.col("n")).drop("_all")


DAY = 86_400


def _alarm_schema(definitions: DataFrame, batch: bool) -> T.StructType:
    kinds = {f.name: f.dataType for f in definitions.schema}
    fields = [T.StructField(n, kinds[n]) for n in monitor.ALARM_KEYS]
    fields += [T.StructField("_at", T.LongType()), T.StructField("_sum", T.DecimalType(38, 4)), T.StructField("_n", T.LongType())]
    return T.StructType([*fields, *([T.StructField("batch", T.LongType())] if batch else []), T.StructField("_day", T.LongType())])


def watch_alarms(points: DataFrame, definitions: DataFrame, target: str, checkpoint: str) -> None:
    """Alarm states kept up to date by a stream of samples, in whatever order they come.

    A batch writes the additive parts of the periods it saw, by day. It then judges again
    only those periods and the ones they can still change: the next periods - 1 of the
    alarm. For that it reads the parts of these and of the periods - 1 before, no older
    history. States go to the batch's own folder; a repeated batch replaces both.
    """
    def judge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        held = _alarm_schema(definitions, False)
        fresh = monitor.alarm_parts(batch, definitions).withColumn("_day", F.floor(F.col("_at") / DAY))
        fresh.select(*[F.col(f.name).cast(f.dataType) for f in held]).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy("_day").parquet(f"{target}/parts/batch={number}")
        mine = spark.read.schema(held).parquet(f"{target}/parts/batch={number}").select(*monitor.ALARM_KEYS, "_at")

        def around(first: Column, last: Column) -> DataFrame:
            places = F.sequence(F.col("_at") + first * F.col("seconds"), F.col("_at") + last * F.col("seconds"), F.col("seconds").cast("long"))
            return mine.select("alarm", "metric_name", F.explode(places).alias("_at")).distinct()

        reach = F.col("periods") - 1
        needed = around(-reach, reach).withColumn("_day", F.floor(F.col("_at") / DAY))
        known = spark.read.schema(_alarm_schema(definitions, True)).parquet(f"{target}/parts")
        # A repeated batch must not see later ones. The days of the needed periods prune the folders that are read.
        days = [r[0] for r in needed.select("_day").distinct().collect()]
        parts = known.where((F.col("batch") <= number) & F.col("_day").isin(days)).join(
            needed.drop("_day"), ["alarm", "metric_name", "_at"], "left_semi")
        states = monitor.alarm_runs(monitor.merge_alarm_parts(parts), DAY)
        changed = around(F.lit(0), reach).select("alarm", "metric_name", F.timestamp_seconds("_at").cast("timestamp_ntz").alias("window_start"))
        states.join(changed, ["alarm", "metric_name", "window_start"], "left_semi").write.mode("overwrite").option(
            "partitionOverwriteMode", "static").parquet(f"{target}/states/batch={number}")

    points.writeStream.foreachBatch(judge).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start().awaitTermination()


def current_alarms(spark: SparkSession, target: str) -> DataFrame:
    """The newest state of every alarm and period."""
    rows = spark.read.parquet(f"{target}/states")
    newest = F.max_by(F.struct("metric_value", "breach", "state"), "batch").alias("s")
    return rows.groupBy("alarm", "metric_name", "window_start").agg(newest).select("alarm", "metric_name", "window_start", "s.*")
