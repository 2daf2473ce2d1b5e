"""Tables in versions: data directories that are never changed, and a manifest that says which of them count.

A manifest is a small file with the version in its name, put in place by one rename; readers take the newest, so they see
a commit wholly or not at all. Directories of an interrupted commit are named nowhere and go with the next ``vacuum``.
One writer at a time, as a stream or a maintenance job is.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorwarden.operators.maintenance import with_event_date


class Files:
    """The few calls to the shared file system that Spark's readers and writers do not make."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self.jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.conf), place

    def names(self, path: str) -> list[str]:
        fs, place = self._at(path)
        return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []

    def read(self, path: str) -> str:
        fs, place = self._at(path)
        stream = fs.open(place)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """The file appears under its name with all of its content."""
        fs, place = self._at(path + ".tmp")
        stream = fs.create(place, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not fs.rename(place, self._at(path)[1]):
            raise OSError(f"could not put {path} in place")

    def delete(self, path: str) -> None:
        fs, place = self._at(path)
        fs.delete(place, True)


class Manifest:
    """Numbered versions of a JSON document below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    def versions(self) -> list[int]:
        found = (name for name in self.files.names(f"{self.root}/manifest") if name.endswith(".json"))
        return sorted(int(name.removesuffix(".json")) for name in found)

    def load(self, version: int) -> dict:
        return json.loads(self.files.read(f"{self.root}/manifest/{version}.json"))

    def latest(self) -> dict | None:
        versions = self.versions()
        return self.load(versions[-1]) if versions else None

    def next_version(self) -> int:
        return (self.versions() or [0])[-1] + 1

    def commit(self, version: int, content: dict) -> None:
        self.files.write(f"{self.root}/manifest/{version}.json", json.dumps(content))

    def data(self, version: int) -> str:
        return f"{self.root}/data/commit={version}"

    def vacuum(self, keep: list[int], used: Callable[[dict], set[int]]) -> None:
        """Deletes all manifests but ``keep`` and every commit that none of those uses."""
        needed = set().union(*(used(self.load(v)) for v in keep)) if keep else set()
        last = max(keep, default=0)
        for version in self.versions():
            if version not in keep:
                self.files.delete(f"{self.root}/manifest/{version}.json")
        for name in self.files.names(f"{self.root}/data"):
            number = int(name.split("=")[1])
            if number not in needed and number <= last:
                self.files.delete(f"{self.root}/data/{name}")


class SnapshotTable:
    """A maintained table (devices, thresholds) as whole versions with an atomic switch."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.manifest = spark, Manifest(spark, root)

    def exists(self) -> bool:
        return bool(self.manifest.versions())

    def read(self) -> DataFrame:
        newest = self.manifest.latest()
        if newest is None:
            raise ValueError(f"no version below {self.manifest.root}")
        return self.spark.read.schema(newest["schema"]).parquet(self.manifest.data(newest["commit"]))

    def write(self, table: DataFrame) -> None:
        """The frame may be made from the version it replaces: that one stays until the next vacuum."""
        version = self.manifest.next_version()
        table.write.mode("overwrite").parquet(self.manifest.data(version))
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
        self.manifest.commit(version, {"commit": version, "schema": schema})

    def update(self, change: Callable[[DataFrame], DataFrame]) -> None:
        self.write(change(self.read()))

    def vacuum(self, keep: int = 2) -> None:
        self.manifest.vacuum(self.manifest.versions()[-keep:], lambda content: {content["commit"]})


class LogTable:
    """Log rows by device-clock date, fed by numbered batches.

    The manifest lists the directories of every date with the batch they came from. A batch that comes again replaces its
    own directories, and ``compact`` leaves the last batch alone, as that is the only one that can come again: so every
    row is there once. Readers open the dates they ask for and nothing else.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.manifest = spark, Manifest(spark, root)

    def _content(self) -> dict:
        return self.manifest.latest() or {"schema": None, "last_batch": None, "parts": []}

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """Commits a batch. Rows of one date and device are written close together."""
        content, version = self._content(), self.manifest.next_version()
        dated = with_event_date(rows)
        parts = [p for p in content["parts"] if p["batch"] != batch_id] + self._written(dated, version, batch_id)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dated.schema.fields)
        self.manifest.commit(version, {"schema": schema, "last_batch": batch_id, "parts": parts})

    def _written(self, dated: DataFrame, version: int, batch_id: int | None) -> list[dict]:
        path = self.manifest.data(version)
        ordered = dated.sortWithinPartitions("event_date", "device_id", "timestamp")
        ordered.write.mode("overwrite").partitionBy("event_date").parquet(path)
        names = (name for name in self.manifest.files.names(path) if name.startswith("event_date="))
        return [{"date": name.split("=")[1], "commit": version, "batch": batch_id} for name in sorted(names)]

    def _read(self, content: dict, parts: list[dict]) -> DataFrame:
        schema = content["schema"] or "id bigint, device_id bigint, timestamp bigint, event_date date"
        if not parts:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.manifest.data(p['commit'])}/event_date={p['date']}" for p in parts]
        reader = self.spark.read.schema(f"{schema}, commit int").option("basePath", f"{self.manifest.root}/data")
        return reader.parquet(*paths).drop("commit")

    def read(self, since: int | None = None, until: int | None = None) -> DataFrame:
        """All rows, or those of the dates from ``since`` to ``until`` (device clock, seconds)."""
        content = self._content()
        low, high = (t and datetime.fromtimestamp(t, UTC).date().isoformat() for t in (since, until))
        parts = [
            p for p in content["parts"] if (low is None or low <= p["date"]) and (high is None or p["date"] <= high)
        ]
        # the default directory holds rows without a usable clock: no range of dates asks for them
        if low or high:
            parts = [p for p in parts if p["date"][:1].isdigit()]
        return self._read(content, parts)

    def parts_per_date(self) -> dict[str, int]:
        counts: dict[str, int] = {}
        for p in self._content()["parts"]:
            counts[p["date"]] = counts.get(p["date"], 0) + 1
        return counts

    def compact(self, most: int = 8, files: int = 1) -> int:
        """Dates in more than ``most`` directories get one, of ``files`` files a date, beside that of the last batch.

        Returns the number of dates that were rewritten.
        """
        content = self._content()
        full = {d for d, n in self.parts_per_date().items() if n > most}
        old = [p for p in content["parts"] if p["date"] in full and p["batch"] != content["last_batch"]]
        if not old:
            return 0
        version = self.manifest.next_version()
        spread = F.pmod(F.xxhash64("device_id"), F.lit(files))
        rows = self._read(content, old).repartition(max(1, len(full) * files), "event_date", spread)
        done = self._written(rows, version, None)
        kept = [p for p in content["parts"] if p not in old]
        self.manifest.commit(version, {**content, "parts": kept + done})
        return len(full)

    def purge(self, as_of: int, retention_days: int) -> int:
        """Deletes rows with a device clock before the cutoff, returns how many.

        Whole dates leave the manifest unread but for their count; only the date of the cutoff is rewritten, each
        directory for itself, so that batches can still be told apart.
        """
        content = self._content()
        limit = as_of - retention_days * 86400
        boundary = datetime.fromtimestamp(limit, UTC).date()
        dated = [p for p in content["parts"] if p["date"][:1].isdigit()]
        gone = [p for p in dated if date.fromisoformat(p["date"]) < boundary]
        edge = [p for p in dated if date.fromisoformat(p["date"]) == boundary]
        deleted = self._read(content, gone).count() + self._read(content, edge).filter(F.col("timestamp") < limit).count()
        kept, version = [p for p in content["parts"] if p not in gone and p not in edge], self.manifest.next_version()
        for p in edge:
            kept += self._written(self._read(content, [p]).filter(F.col("timestamp") >= limit), version, p["batch"])
            self.manifest.commit(version, {**content, "parts": kept + edge[edge.index(p) + 1 :]})
            version += 1
        if gone and not edge:
            self.manifest.commit(version, {**content, "parts": kept})
        return deleted

    def vacuum(self, keep: int = 2) -> None:
        self.manifest.vacuum(self.manifest.versions()[-keep:], lambda content: {p["commit"] for p in content["parts"]})
