"""Stream ingest I1-I4: source -> contract (B4-B6) -> routing -> idempotent append.

* Source: Kafka in production (``format("kafka")``, key/value bytes), JSON
  lines files in tests (the Kafka connector jar is not bundled with PySpark).
* Every message is validated by ``apply_contract``; valid rows go to the
  price table, invalid ones with their raw text and error to a dead-letter
  table (the reference only logged them and stopped on non-object JSON).
* ``foreachBatch`` applies insert-if-absent (first arrival per key wins inside a batch, stored rows win over new ones).
  Arrival is the file's modification time, then path, split and position in the split (files), or the message time,
  partition and offset (Kafka).
* Rows and dead letters carry their epoch and a name of the attempt that wrote them. An epoch counts when its one
  record is put into the commit log (``commits``, atomic, once); it names the attempt and holds the epoch's totals.
  Readers see rows of committed attempts only, so a failure between any two writes leaves nothing half
  done: a replayed epoch writes a new attempt, and one that was committed is passed over. With the offsets in the
  checkpoint the ingest is effectively once, end to end.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickwise.functions.cleaning import apply_contract
from tickwise.sources import commits
from tickwise.sources.sinks import append_partitioned, insert_if_absent, read_or_empty

PRICE_SCHEMA = ("ticker string, timestamp timestamp, open double, high double, low double, "
                "close double, volume bigint")
KEYS = ["ticker", "timestamp"]
ARRIVAL = ["_arrived", "_src", "_block", "_seq"]      # order of arrival
COMMIT_SCHEMA = "epoch long, attempt string, consumed long, inserted long, errors long"


def file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines message files -> value and arrival (file time, path, split; ``IngestBatch`` adds the position)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    meta = F.col("_metadata")
    return r.load(path).select("value", meta["file_modification_time"].alias("_arrived"), meta["file_path"].alias("_src"),
                               meta["file_block_start"].alias("_block"))


def kafka_source(spark: SparkSession, servers: str, topic: str = "stock-prices",
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Kafka topic -> value and arrival (message time, partition, offset); earliest offsets."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", "earliest"))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return from_kafka(r.load())


def from_kafka(messages: DataFrame) -> DataFrame:
    """Columns of the Kafka source -> value and arrival."""
    return messages.select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("_arrived"),
                           F.col("partition").cast("string").alias("_src"), F.lit(0).cast("long").alias("_block"),
                           F.col("offset").cast("long").alias("_seq"))


def parse(stream: DataFrame) -> DataFrame:
    """Contract columns + ``error`` + raw value and arrival order."""
    d = apply_contract(stream.select(F.col("value").alias("raw"), *ARRIVAL), "raw")
    return d.select("ticker", "timestamp", "open", "high", "low", "close", "volume", "error", "raw", *ARRIVAL)


def _record(stats: str, epoch_id: int) -> str:
    return f"{stats}/{epoch_id:012d}.json"


def _committed(rows: DataFrame, log: DataFrame) -> DataFrame:
    """Rows of committed attempts; the log has one small row for each epoch."""
    done = log.select(F.col("epoch").alias("ingest_epoch"), "attempt")
    return rows.join(done, ["ingest_epoch", "attempt"], "left_semi")


def commit_log(spark: SparkSession, stats: str) -> DataFrame:
    """(epoch, attempt, consumed, inserted, errors) of the committed epochs."""
    if not commits.names(spark, stats):
        return spark.createDataFrame([], COMMIT_SCHEMA)
    return spark.read.schema(COMMIT_SCHEMA).json(stats)


def read_prices(spark: SparkSession, target: str, stats: str) -> DataFrame:
    """The price table: rows of committed epochs, with ``ingest_epoch``, ``attempt`` and ``year``."""
    rows = read_or_empty(spark, target, PRICE_SCHEMA + ", ingest_epoch long, attempt string, year int")
    return _committed(rows, commit_log(spark, stats))


def read_dead_letters(spark: SparkSession, dead_letter: str, stats: str) -> DataFrame:
    """(raw, error, ingest_epoch) of committed epochs."""
    rows = read_or_empty(spark, dead_letter, "raw string, error string, attempt string, ingest_epoch long")
    return _committed(rows, commit_log(spark, stats)).drop("attempt")


class IngestBatch:
    """``foreachBatch`` handler: prices, dead letters, then the epoch's commit record with its totals."""

    def __init__(self, target: str, dead_letter: str, stats: str):
        self.target, self.dead_letter, self.stats = target, dead_letter, stats

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        if commits.exists(spark, _record(self.stats, epoch_id)):
            return      # committed by an earlier attempt that failed after it
        attempt = uuid.uuid4().hex
        if "_seq" not in batch.columns:
            # grows inside a split, which one task reads in order
            batch = batch.withColumn("_seq", F.monotonically_increasing_id())
        batch = parse(batch).persist()
        try:
            mark = [F.lit(epoch_id).cast("long").alias("ingest_epoch"), F.lit(attempt).alias("attempt")]
            valid = batch.filter(F.col("error").isNull())
            invalid = batch.filter(F.col("error").isNotNull())
            # the target is partitioned by year: joining on year as well lets
            # dynamic partition pruning read only the years present in the batch
            existing = read_prices(spark, self.target, self.stats)
            batch_rows = valid.drop("raw", "error").withColumn("year", F.year("timestamp"))
            new = insert_if_absent(batch_rows, existing, KEYS + ["year"], ARRIVAL)
            inserted, errors = Observation(), Observation()
            append_partitioned(new.drop("year", *ARRIVAL).select("*", *mark).observe(inserted, F.count(F.lit(1)).alias("n")), self.target)
            (invalid.select("raw", "error", *mark).observe(errors, F.count(F.lit(1)).alias("n"))
             .write.mode("append").partitionBy("ingest_epoch").parquet(self.dead_letter))
            n_errors = int(errors.get["n"])
            commits.put_if_absent(spark, _record(self.stats, epoch_id), {
                "epoch": epoch_id, "attempt": attempt, "consumed": batch.count() - n_errors, "inserted": int(inserted.get["n"]), "errors": n_errors})
        finally:
            batch.unpersist()


def run_ingest(stream: DataFrame, target: str, dead_letter: str, stats: str,
               checkpoint: str, available_now: bool = True):
    """Start the query (``availableNow`` drains what is there and stops)."""
    w = stream.writeStream.foreachBatch(IngestBatch(target, dead_letter, stats)) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    return w.start()


def totals(spark: SparkSession, stats: str) -> DataFrame:
    """(consumed, inserted, errors) over all committed epochs, as the reference returns."""
    return commit_log(spark, stats).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
                                          for c in ("consumed", "inserted", "errors")])
