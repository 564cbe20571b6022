"""Feature tables: training feature store (Parquet), scoring rows (Parquet or headerless CSV)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..schemas import FEATURE, FEATURE_COLUMNS, INFER, INFER_COLUMNS
from ..session import materialize, release

KEY_COLUMNS = ["apartment_record_id", "event_time"]


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files under ``path`` as one table (a multi-file scan, no driver concat).

    Partition discovery stays on: ``event_date`` lives in the folder names of
    the store, so a recursive file listing (which turns discovery off) would
    lose it.
    """
    try:
        df = spark.read.schema(FEATURE).parquet(path)
    except AnalysisException as exc:
        raise FileNotFoundError(f"The feature store {path} cannot be read") from exc
    if not _has_data(spark, path):
        raise FileNotFoundError(f"The feature store {path} has no data files")
    return df


def _has_data(spark: SparkSession, path: str) -> bool:
    """Whether some file under ``path`` is data. Looks at one after another up to the first that is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(folder, True)
    while files.hasNext():
        if not files.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def write_features(df: DataFrame, path: str, reject_path: str | None = None) -> None:
    """Append feature rows partitioned by event_date.

    Rows without a record id or event time cannot be keyed by the store;
    they go to ``reject_path`` (when given) instead of the store; the rows are then staged, so that
    they are computed once. Writers are rebalanced by date. Nothing is collected to the driver.
    """
    ok = F.col("apartment_record_id").isNotNull() & F.col("event_time").isNotNull()
    tagged = df.select(*FEATURE_COLUMNS).withColumn("_ok", ok)
    if reject_path:
        tagged = materialize(tagged, "features")
    tagged.where("_ok").drop("_ok").hint("rebalance", "event_date") \
        .write.mode("append").partitionBy("event_date").parquet(path)
    if reject_path:
        tagged.where("NOT _ok").drop("_ok").write.mode("append").parquet(reject_path)
        release(tagged)


def write_inference_features(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite scoring rows; ``csv`` writes the fixed column order without a header."""
    cols = [c for c in INFER_COLUMNS if c in df.columns]
    w = df.select(*cols).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", "false").csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"Unsupported format: {fmt}")


def read_inference_features(spark: SparkSession, path: str, content_type: str = "text/csv",
                            feature_columns=None) -> DataFrame:
    """Scoring rows. ``text/csv``: headerless, names attached by position
    (3 ids + features, or features only); ``application/x-parquet``: typed."""
    if content_type == "application/x-parquet":
        return spark.read.schema(INFER).parquet(path)
    if content_type != "text/csv":
        raise ValueError(f"Unsupported content type: {content_type}")
    raw = spark.read.option("header", "false").option("inferSchema", "false").csv(path)
    return attach_names(raw, feature_columns or INFER_COLUMNS[3:])


def attach_names(df: DataFrame, feature_columns) -> DataFrame:
    """Name positional columns: n features, or 3 ids + n features; else ValueError.

    Id columns that are absent become null columns so both shapes give the
    same output schema.
    """
    feats = list(feature_columns)
    n = len(df.columns)
    if n == len(feats):
        named = df.toDF(*feats)
        ids = [F.lit(None).cast("string").alias(c) for c in ("apartment_id", "building_id", "event_date")]
    elif n == len(feats) + 3:
        named = df.toDF("apartment_id", "building_id", "event_date", *feats)
        ids = [F.col(c).cast("string").alias(c) for c in ("apartment_id", "building_id", "event_date")]
    else:
        raise ValueError(f"Input data columns ({n}) do not match expected feature columns ({len(feats)})")
    return named.select(*ids, *[F.col(c).try_cast("double").alias(c) for c in feats])
