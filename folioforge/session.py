"""Session factory and the few helpers every operator shares."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Settings the engine wants; a session made elsewhere keeps its own.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "folioforge", **conf: str) -> SparkSession:
    """A session with the engine's defaults; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    for key, value in (DEFAULTS | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Read one parquet table of a data directory."""
    return spark.read.parquet(f"{base}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Where ``spark.checkpoint.dir`` is unset, a local session (tests) uses a temporary folder; any other raises, since a
    folder of one machine doesn't survive it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    sc = spark.sparkContext
    if shared:
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            sc.setCheckpointDir(shared)
        return shared
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no shared folder")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="folioforge-ckpt-"))
    return sc._jsc.sc().getCheckpointDir().get()


def checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def python_tasks(spark: SparkSession, bytes_hint: int = 0) -> int:
    """Number of partitions for Python-heavy stages: follows the session's shuffle width and the input size."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(width, bytes_hint // (32 << 20))
