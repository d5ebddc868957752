"""EXT-16 as a stream: current notional maintained from immutable trade events.

Trade events are append-only and immutable; a correction is a new event.
New event files landing in a folder are read as a stream. Spark's state store holds the
event keys seen and a running sum per arrangement: a redelivery is dropped however late it
comes, as in the batch rule, and a micro-batch reads its own events and the state of the
keys in them, never the events before. The notionals that a batch changes are written as
one folder of a change table, so its cost does not grow with the table either; a batch
replayed after a failure writes its folder again. :func:`current_notional` reads the
newest row of each arrangement.

The batch operator :func:`ledgerlens.operators.extensions.notional_as_of` is
the correctness reference: after the stream has consumed every file, the
table equals the batch result over the same events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.plans.warehouse import Warehouse, dedupe_on_keys

EVENT_SCHEMA = T.StructType([
    T.StructField("event_key", T.StringType()),
    T.StructField("arrangement_key", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("economic_event_date", T.DateType()),
    T.StructField("notional_delta", T.DecimalType(20, 2)),
])

CHANGES = "rpt.current_notional_change"

# The state grows with the events: it lies in RocksDB on the executors' disks, and a batch
# commits what it changed in it to the checkpoint folder.
_STATE = "spark.sql.streaming.stateStore."
STATE_STORE = {
    f"{_STATE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}rocksdb.changelogCheckpointing.enabled": "true",
}


def running_notional(events: DataFrame) -> DataFrame:
    """Sum, number and last date of each arrangement's events, each event key once. Over a
    stream both steps keep their state; events without a key are left out."""
    return (events.where("event_key is not null").dropDuplicates(["event_key"])
            .groupBy("arrangement_key")
            .agg(F.sum("notional_delta").cast("decimal(38,2)").alias("notional_outstanding"),
                 F.count(F.lit(1)).alias("events"),
                 F.max("economic_event_date").alias("last_event_date")))


def start_notional_stream(spark: SparkSession, source_dir: str, warehouse: Warehouse,
                          checkpoint_location: str, table: str = CHANGES, available_now: bool = True,
                          max_files_per_trigger: int | None = None, most_folders: int = 64) -> StreamingQuery:
    """Run the stream from Parquet event files into the change table ``table``.

    ``table`` belongs to ``checkpoint_location``, which numbers its folders: a stream with a
    new checkpoint needs a new table. More than ``most_folders`` folders of earlier batches
    are made one before a batch is written, never the batch's own, which may be replayed.
    """
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def absorb(changed: DataFrame, batch: int) -> None:
        warehouse.fold(table, ("arrangement_key",), "batch", batch, most_folders)
        changed = changed.withColumn("batch", F.lit(batch).cast("long")).persist()
        try:
            warehouse.upsert(table, changed, ("arrangement_key",), partition_col="batch", snapshot=True)
        finally:
            changed.unpersist()
        warehouse.forget(table)

    writer = (running_notional(reader.parquet(source_dir)).writeStream.outputMode("update")
              .option("checkpointLocation", checkpoint_location).foreachBatch(absorb))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def current_notional(warehouse: Warehouse, table: str = CHANGES) -> DataFrame:
    """The newest row of each arrangement, as the last batch that touched it left it."""
    return dedupe_on_keys(warehouse.read(table), ["arrangement_key"], ["batch"]).drop("batch")
