"""New score files -> alerts upserted into the alert store, once per file."""

from __future__ import annotations

from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.alerts import DEFAULT_THRESHOLD, alert_counts, dedupe_alerts, make_alerts, parse_scores
from ..session import materialize, release
from ..sources import quarantine
from ..sources.alerts_store import upsert_alerts
from ..sources.scores import JSON_SUFFIXES, SCORE_DDL, parse_score_lines


def stream_alerts(spark: SparkSession, scores_dir: str, store_path: str, checkpoint: str,
                  threshold: float = DEFAULT_THRESHOLD, alert_time=None, suffixes=("csv", "out", *JSON_SUFFIXES),
                  rejects_path: str | None = None, counts_path: str | None = None,
                  quarantine_path: str | None = None, max_files_per_trigger: int = 1000) -> None:
    """Process every score file not yet seen, CSV lines or (by suffix) JSON Lines.

    Each micro-batch is merged into the store with ``upsert_alerts`` (idempotent per AlertID, so a
    replayed batch after a failure leaves the same store). Rejected rows and counts per file are
    written under ``rejects_path`` and ``counts_path``, one folder per batch (``batch=N``), which a
    replay replaces.

    Without ``quarantine_path`` an unreadable file fails the run: its rows are never dropped unseen.
    With it, a micro-batch is a list of files, and those that cannot be read whole are set aside there with
    the reason, while the alerts of all others are written. Each run first tries the files that are still
    set aside; those that can be read now are processed like new ones (their rejects and counts go to
    ``batch=retry-<time>``).
    """
    glob = "*.{" + ",".join(suffixes) + "}"

    def handle(lines: DataFrame, batch) -> None:
        is_json = F.col("source_file").rlike(r"\.(" + "|".join(JSON_SUFFIXES) + ")$")
        text = parse_score_lines(lines.where(~is_json)).unionByName(parse_json_lines(lines.where(is_json)))
        good, bad = parse_scores(text)
        upsert_alerts(spark, dedupe_alerts(make_alerts(good, threshold, alert_time)), store_path)
        if rejects_path:
            bad.write.mode("overwrite").parquet(f"{rejects_path.rstrip('/')}/batch={batch}")
        if counts_path:
            alert_counts(good, bad, threshold).write.mode("overwrite").parquet(f"{counts_path.rstrip('/')}/batch={batch}")

    def read(files: list[str]) -> DataFrame:
        return spark.read.text(files).select("value", F.col("_metadata.file_path").alias("source_file"))

    def handle_files(files: list[str], batch) -> dict[str, str]:
        staged, bad = quarantine.read_apart(files, read, "score-lines")
        if staged:
            handle(reduce(DataFrame.unionByName, staged), batch)
        release(*staged)
        return bad

    def merge_rows(batch, epoch):
        staged = materialize(batch, "score-lines")       # read once, used for alerts, rejects and counts
        handle(staged, epoch)
        release(staged)

    def merge_files(batch, epoch):
        files = sorted(r[0] for r in batch.select("path").collect())        # at most max_files_per_trigger names
        quarantine.record(spark, quarantine_path, handle_files(files, epoch), [], f"batch {epoch}")

    if quarantine_path:
        now = datetime.now(UTC).strftime("%Y-%m-%dT%H-%M-%S-%f")
        waiting = sorted(r[0] for r in quarantine.entries(spark, quarantine_path, quarantine.OPEN).select("source_file").collect())
        for i in range(0, len(waiting), max_files_per_trigger):
            files = waiting[i:i + max_files_per_trigger]
            still = handle_files(files, f"retry-{now}-{i}")
            quarantine.record(spark, quarantine_path, still, [f for f in files if f not in still], now)
        # Names only: the content is not among the columns read.
        source = spark.readStream.schema("path string, modificationTime timestamp, length long, content binary").format("binaryFile")
    else:
        source = spark.readStream.format("text")
    new = source.option("pathGlobFilter", glob).option("recursiveFileLookup", "true") \
        .option("maxFilesPerTrigger", max_files_per_trigger).load(scores_dir)
    new = new.select("path") if quarantine_path else new.select("value", F.col("_metadata.file_path").alias("source_file"))
    q = (new.writeStream.foreachBatch(merge_files if quarantine_path else merge_rows)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def parse_json_lines(lines, value_col: str = "value"):
    """JSON text lines -> the four text fields + ``_corrupt_record``, as ``parse_score_lines`` gives for CSV."""
    parsed = F.from_json(F.col(value_col), SCORE_DDL, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return lines.select(*[parsed[c].alias(c) for c in ("apartment_id", "building_id", "event_date", "anomaly_score_combined")],
                        F.when(F.trim(value_col) == "", F.col(value_col)).otherwise(parsed["_corrupt_record"]).alias("_corrupt_record"),
                        *[c for c in lines.columns if c != value_col])
