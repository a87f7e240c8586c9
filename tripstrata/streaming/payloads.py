"""File events as a stream of JSON messages: each is validated, taken once, recorded and handled.

Messages are lines of text files. What has been taken is state of the query: an accepted event counts once per file
path, a rejected message once per text, also over restarts. The state holds one digest per event and never shrinks, as
a path may be announced again at any time; it is kept by RocksDB, outside the executors' heaps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripstrata.schemas import FILE_EVENT_SCHEMA
from tripstrata.sources.layers import Layers
from tripstrata.streaming.arrivals import read_arrivals, rebuild_months
from tripstrata.streaming.events import file_name_of, parse_events

ACCEPTED_SCHEMA = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FILE_EVENT_SCHEMA)
REJECTED_SCHEMA = "payload string, reject_reason string"

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_messages(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of `payload`, one message per line of the folder's files."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true").option("maxFileAge", "36500d")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder).select(F.col("value").alias("payload"))


def _event_key() -> Column:
    """What makes two messages the same: the path of an accepted event, the text of a rejected one."""
    path, text = F.concat(F.lit("path:"), "file_path"), F.concat(F.lit("text:"), "payload")
    return F.unhex(F.sha2(F.when(F.col("reject_reason").isNull(), path).otherwise(text), 256))


def new_events(messages: DataFrame) -> DataFrame:
    """Validated messages (`payload`, event columns, `reject_reason`) that have not been taken before.

    Of events that name one path, and come in one micro-batch, any may be the one that is taken.
    """
    return parse_events(messages).withColumn("event_key", _event_key()).dropDuplicates(["event_key"]).drop("event_key")


def _resolved(root: str) -> Column:
    """A relative path lies under `root`."""
    path = F.col("file_path")
    return F.when(path.rlike(r"^([a-zA-Z][a-zA-Z0-9+.-]*:|/)"), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


def start_messages(
    spark: SparkSession,
    folder: str,
    layers: Layers,
    checkpoint: str,
    *,
    handle: Callable[[SparkSession, DataFrame], None] | None = None,
    max_files_per_trigger: int | None = None,
    poll_seconds: int | None = None,
) -> StreamingQuery:
    """Start the query. Each micro-batch writes its accepted and its rejected events, then hands the former to `handle`.

    Both tables keep a batch's rows under the query's id and the batch's number, so a repeated batch replaces its own
    rows. Without `poll_seconds` the query handles what is there and stops.
    """

    def record(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        run = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        place = f"query={run}/batch={number}"
        events = batch.persist()
        try:
            accepted = events.filter("reject_reason IS NULL").select(*FILE_EVENT_SCHEMA.names)
            accepted.write.mode("overwrite").parquet(f"{layers.accepted_events}/{place}")
            rejected = events.filter("reject_reason IS NOT NULL").select("payload", "reject_reason")
            rejected.write.mode("overwrite").parquet(f"{layers.rejected_events}/{place}")
        finally:
            events.unpersist()
        if handle is not None:
            # What was written, so that handling never depends on what a recomputed batch would choose.
            handle(session, session.read.schema(ACCEPTED_SCHEMA).parquet(f"{layers.accepted_events}/{place}"))

    events = new_events(read_messages(spark, folder, max_files_per_trigger))
    writer = events.writeStream.outputMode("append").foreachBatch(record).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if poll_seconds is None else {"processingTime": f"{poll_seconds} seconds"}
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKS_DB)  # the query keeps the setting that it started with
    try:
        return writer.trigger(**trigger).start()
    finally:
        spark.conf.set(_STORE, before)


def month_builder(incoming: str, archive: str | None, zone_csv: str, layers: Layers, root: str) -> Callable[[SparkSession, DataFrame], None]:
    """A `handle` that rebuilds the months of the announced files; relative paths lie under `root`."""

    def handle(spark: SparkSession, accepted: DataFrame) -> None:
        rebuild_months(spark, accepted.select(_resolved(root).alias("path")), incoming, archive, zone_csv, layers)

    return handle


def read_accepted(spark: SparkSession, layers: Layers) -> DataFrame:
    return spark.read.schema(f"{ACCEPTED_SCHEMA}, query string, batch int").parquet(layers.accepted_events)


def read_rejected(spark: SparkSession, layers: Layers) -> DataFrame:
    return spark.read.schema(f"{REJECTED_SCHEMA}, query string, batch int").parquet(layers.rejected_events)


def start_publisher(spark: SparkSession, incoming: str, layers: Layers, checkpoint: str, *, poll_seconds: int | None = None) -> StreamingQuery:
    """Record each new file as published, one file a micro-batch, the oldest first, with the batch's number.

    The number orders the files; a repeated batch replaces its own row, and a restarted query goes on after the last.
    """

    def publish(batch: DataFrame, number: int) -> None:
        named = batch.select("path", file_name_of(F.col("path")).alias("file_name"))
        named.write.mode("overwrite").parquet(f"{layers.published_files}/batch={number}")

    arrivals = read_arrivals(spark, incoming, max_files_per_trigger=1)
    writer = arrivals.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if poll_seconds is None else {"processingTime": f"{poll_seconds} seconds"}
    return writer.trigger(**trigger).start()


def read_published(spark: SparkSession, layers: Layers) -> DataFrame:
    return spark.read.schema("path string, file_name string, batch int").parquet(layers.published_files)
