"""The progress state of a live log.

``stream`` keeps the last line of each key in update mode; ``snapshot`` drives a folder of log files to its end and
returns the state. State is one small struct per key, kept by Spark's state store and checkpointed in the shared folder;
a crash replays whole batches, and since the last line is a maximum, replays change nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators.progress import note_key
from folioforge.session import checkpoint, checkpoint_dir


def stream(log: DataFrame) -> DataFrame:
    """Streaming counterpart of ``progress.latest``."""
    good = log.where(F.col("db").isNotNull() & F.col("unid").isNotNull() & F.col("line_no").isNotNull())
    last = good.groupBy("db", note_key(F.col("unid")).alias("unid")).agg(F.max(F.struct("line_no", "ts", "status", "try_no", "err", "out_path")).alias("l"))
    return last.select("db", "unid", "l.*")


def windowed(log: DataFrame, late: str = "30 days", width: str = "1 day") -> DataFrame:
    """Lines per status and window of their own time, with late lines taken up to the watermark."""
    timed = log.withColumn("at", F.col("ts").try_cast("timestamp")).where(F.col("at").isNotNull()).withWatermark("at", late)
    return timed.groupBy(F.window("at", width), "status").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "status", "n")


def _source(spark: SparkSession, path: str) -> tuple[str, str]:
    """Folder to watch and the names to take there; a single file is watched through its folder."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    if own.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(own).isDirectory():
        return path, "*.parquet"
    return str(own.getParent()), own.getName()


def snapshot(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Read a folder of parquet log files as a stream to its end; the state after the last batch.

    Each batch is folded into a table in the shared checkpoint folder, so the result doesn't live on the driver; what the
    stream wrote is deleted once the state is checkpointed.
    """
    schema = spark.read.parquet(path).schema
    own = f"{checkpoint_dir(spark)}/progress-{uuid.uuid4().hex}"
    folder, names = _source(spark, path)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", names).parquet(folder)

    def fold(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{own}/batch={number}")

    query = stream(source).writeStream.outputMode("update").option("checkpointLocation", f"{own}-state").foreachBatch(fold).trigger(availableNow=True).start()
    query.awaitTermination()
    changes = spark.read.parquet(own)
    columns = ["line_no", "ts", "status", "try_no", "err", "out_path"]
    state = changes.groupBy("db", "unid").agg(F.max(F.struct("batch", *columns)).alias("m")).select("db", "unid", *[f"m.{c}" for c in columns])
    state = checkpoint(state)
    for used in (own, f"{own}-state"):
        folder_ = spark._jvm.org.apache.hadoop.fs.Path(used)
        folder_.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder_, True)
    return state
