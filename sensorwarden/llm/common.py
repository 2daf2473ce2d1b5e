"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word, line and dedup contracts: [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"


_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Only where it is unset (tests, a laptop) one temporary folder per application is made.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        application = spark.sparkContext.applicationId
        if application not in _own_folders:
            _own_folders[application] = tempfile.mkdtemp(prefix="corpus-")
        folder = _own_folders[application]
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; the caller of the job clears that folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """The frame as a table in the shared folder: computed once, lineage cut, lost executors cost nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a file, about: of light tables, and of tables with whole sets or texts, or made from them.
LIGHT_ROWS, HEAVY_ROWS = 10_000, 1_000

#: Rows of a file of a table with an outline or the like (some hundred bytes) a row, about.
MIDDLE_ROWS = 5_000


def gathered(df: DataFrame, rows: int, per_file: int = LIGHT_ROWS) -> DataFrame:
    """The frame in as few partitions as its rows need; rows: no more than so many go into it, or come out of it.

    A shuffle has as many partitions as the whole job needs. A small table written after it would be that many files, each
    with a task of its own and, on a local file system, with child processes that set its permissions.
    """
    return df.coalesce(max(1, -(-rows // per_file)))


_tables: dict = {}


def let_go() -> None:
    """Frees what an operator before has left in this Python worker; for tasks that keep no table themselves.

    Tables may refer to themselves, so that only a collection gives their memory back.
    """
    if _tables:
        _tables.clear()
        gc.collect()


def worker_table(key, make: Callable[[], Any]):
    """A table that a Python worker keeps between tasks. Only the latest is kept: a worker that turns to another operator
    lets go of what the one before has left.
    """
    if key not in _tables:
        let_go()
        _tables[key] = make()
    return _tables[key]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this subpackage to the Python workers, once per application, so that it need not be installed there.

    The archive is made on the driver; Spark hands it to the executors.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="corpus-code-"), "sensorwarden_corpus.zip")
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("sensorwarden/__init__.py", "")
        for name in sorted(os.listdir(here)):
            if name.endswith(".py"):
                archive.write(os.path.join(here, name), f"sensorwarden/llm/{name}")
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def partitions(spark: SparkSession) -> int:
    """Tasks of a shuffle, as the session sizes them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, name: str) -> str:
    """A column name the frame does not have yet (names count regardless of case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without_spaces(text: Column) -> Column:
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def utf8_sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "utf-8"), 256)
