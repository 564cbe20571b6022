"""Incremental ingest: only files not seen before are cleaned and appended.

The streaming checkpoint records which files were processed (it plays the
role of a job bookmark); ``availableNow`` processes everything new in
bounded batches and stops, so the job can run on a schedule.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean_meter
from ..schemas import PARTITION_COLUMNS, RAW
from ..sources.meter_batches import write_batch

AUDIT_SCHEMA = "run string, stream string, batch long, rows_read long, rows_written long, finished string"


def ingest_incremental(spark: SparkSession, source: str, dest: str, checkpoint: str, fmt: str = "json",
                       schema=RAW, max_files_per_trigger: int = 1000, table: str | None = None,
                       writers_per_day: int = 8) -> dict | None:
    """Clean new raw files under ``source``, at any depth, into the partitioned Parquet table ``dest``.

    A batch's rows of one day go to at most ``writers_per_day`` tasks, so a batch adds few files per
    folder (a batch is bounded by ``max_files_per_trigger``). With ``table`` the folders are also
    registered in the session catalog. Returns the last progress report (None when nothing was new).
    """
    stream = (spark.readStream.schema(schema).format(fmt)
              .option("maxFilesPerTrigger", max_files_per_trigger).option("recursiveFileLookup", "true")
              .load(source))
    salt = F.pmod(F.xxhash64("meter_id", "event_ts"), F.lit(writers_per_day))
    query = (clean_meter(stream).repartition(*PARTITION_COLUMNS, salt).writeStream.format("parquet")
             .option("checkpointLocation", checkpoint)
             .partitionBy(*PARTITION_COLUMNS)
             .trigger(availableNow=True)
             .start(dest))
    query.awaitTermination()
    if table:
        register(spark, table, dest)
    return query.lastProgress


def register(spark: SparkSession, table: str, path: str) -> None:
    """Make the partitioned Parquet folder ``path`` a catalog table, with all its present partitions."""
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=path, source="parquet")
    spark.catalog.recoverPartitions(table)


def ingest_batches(spark: SparkSession, source: str, dest: str, checkpoint: str, audit_path: str, fmt: str = "json",
                   schema=RAW, max_files_per_trigger: int = 1000, stream: str = "meter") -> dict:
    """Clean new raw files under ``source`` into the replayable meter table ``dest`` (``meter_batches``), with an audit.

    Each micro-batch is one batch of the table, so one that is processed again after a failure replaces itself. Its
    counts are observed on its write and kept under ``audit_path`` as soon as it is written (one folder per batch, which
    a replay replaces), so they cover every micro-batch of a run, also of one that failed later. Adaptive execution
    sizes the writers of each day by bytes. Returns {run, batches, rows_read, rows_written} of this run.
    """
    run = uuid.uuid4().hex
    files = (spark.readStream.schema(schema).format(fmt)
             .option("maxFilesPerTrigger", max_files_per_trigger).option("recursiveFileLookup", "true")
             .load(source))

    def write(batch: DataFrame, number: int) -> None:
        read, written = (Observation(f"{n}-{run}-{number}") for n in ("read", "written"))
        rows = clean_meter(batch.observe(read, F.count(F.lit(1)).alias("n"))).observe(written, F.count(F.lit(1)).alias("n"))
        write_batch(spark, rows, dest, f"{stream}-{number}")
        counts = spark.createDataFrame([(run, stream, number, read.get["n"], written.get["n"])],
                                       "run string, stream string, batch long, rows_read long, rows_written long")
        counts.withColumn("finished", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).coalesce(1) \
            .write.mode("overwrite").parquet(f"{audit_path.rstrip('/')}/{stream}-{number}")

    query = files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    total = read_audit(spark, audit_path).where(F.col("run") == run) \
        .agg(F.count(F.lit(1)), F.coalesce(F.sum("rows_read"), F.lit(0)), F.coalesce(F.sum("rows_written"), F.lit(0))).first()
    return {"run": run, "batches": total[0], "rows_read": total[1], "rows_written": total[2]}


def read_audit(spark: SparkSession, audit_path: str) -> DataFrame:
    """Counts per micro-batch: (run, stream, batch, rows_read, rows_written, finished). None where nothing ran yet."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(audit_path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], AUDIT_SCHEMA)
    return spark.read.schema(AUDIT_SCHEMA).option("recursiveFileLookup", "true").parquet(audit_path)
