"""Session settings the engine relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Event text and date partitions are defined in UTC; with duplicate JSON keys the last one wins. Generated methods
# above 8000 bytes are never compiled by the JIT: such a stage runs faster as single operators.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "sensorwarden", **conf: str) -> SparkSession:
    """A session with adaptive execution and the engine settings.

    Master, memory and shuffle sizing come from spark-submit; extra settings may be passed with
    underscores in place of dots for tests.
    """
    builder = SparkSession.builder.appName(app).config("spark.sql.adaptive.enabled", "true")
    for key, value in {**ENGINE_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_engine_conf(spark: SparkSession) -> None:
    """Apply the engine settings to a session somebody else created."""
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)


_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; all executors share it.

    Only where it is unset (tests, a laptop) one temporary folder per application is made.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        application = spark.sparkContext.applicationId
        if application not in _own_folders:
            _own_folders[application] = tempfile.mkdtemp(prefix="sensorwarden-")
        folder = _own_folders[application]
    return folder.rstrip("/")


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """The frame as a table in the shared folder: computed once, read with its columns pruned; a lost executor costs nothing.

    Tables are left for the owner of the folder to clear.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
