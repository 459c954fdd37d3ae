"""Session defaults and the shared folder that holds materialised stage tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "remitlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans rely on; the cluster's own values win if given."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    A private temporary folder is used only by a local-mode session that names none; on a
    cluster a machine-local folder would be lost with its machine, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="remitlens-")
    return _LOCAL_DIRS[app]


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write once, read back: cuts lineage durably, so a lost executor never re-derives rows
    (and never re-derives them differently), and later readers get pruned Parquet scans."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/remitlens/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
