"""The memory of all nodes between micro-batches: hash buckets that are rewritten only when a batch touches them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorwarden.schemas import NODE_STATE
from sensorwarden.sources.versioned import Manifest


class NodeStateTable:
    """node_state rows in ``buckets`` directories, copied on write.

    A batch reads the buckets of its own nodes and writes those again; the manifest of the batch points to the newest
    directory of every bucket and keeps the counters of the stream. State and counters before a batch are those of the
    newest manifest of an earlier batch, so a batch that comes again starts from the same place. The number of buckets is
    fixed with the first batch.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.manifest, self._buckets = spark, Manifest(spark, root), buckets

    def _before(self, batch_id: int | None) -> dict:
        for version in reversed(self.manifest.versions()):
            content = self.manifest.load(version)
            if batch_id is None or content["batch"] < batch_id:
                return content
        return {"batch": -1, "buckets": {}, "of": self._buckets, "counters": {}}

    def bucket(self, node: Column, of: int) -> Column:
        return F.pmod(F.xxhash64(node), F.lit(of)).cast("int")

    def _read(self, content: dict, wanted: set[int] | None = None) -> DataFrame:
        paths = [
            f"{self.manifest.data(commit)}/bucket={bucket}"
            for bucket, commit in sorted(content["buckets"].items())
            if wanted is None or int(bucket) in wanted
        ]
        if not paths:
            return self.spark.createDataFrame([], NODE_STATE)
        return self.spark.read.schema(NODE_STATE).parquet(*paths)

    def read(self, before_batch: int | None = None) -> DataFrame:
        """State of all nodes, of the last batch or before one."""
        return self._read(self._before(before_batch))

    def counters(self, before_batch: int | None = None) -> dict[str, int]:
        return dict(self._before(before_batch)["counters"])

    def touched(self, nodes: DataFrame) -> set[int]:
        """The buckets of these nodes: at most as many numbers as there are buckets come to the driver."""
        of = self._before(None)["of"]
        return {row[0] for row in nodes.select(self.bucket(F.col("node_id"), of)).distinct().collect()}

    def of_buckets(self, batch_id: int, wanted: set[int]) -> DataFrame:
        return self._read(self._before(batch_id), wanted)

    def commit(self, rows: DataFrame, batch_id: int, wanted: set[int], counters: dict[str, int]) -> None:
        """``rows`` is the whole new content of the wanted buckets; ``counters`` are added to those before the batch."""
        content, version = self._before(batch_id), self.manifest.next_version()
        placed = rows.withColumn("bucket", self.bucket(F.col("node_id"), content["of"]))
        # a task per bucket, so a bucket is one file
        placed.repartition(max(1, len(wanted)), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(self.manifest.data(version))
        names = self.manifest.files.names(self.manifest.data(version))
        new = {name.split("=")[1]: version for name in names if name.startswith("bucket=")}
        total = {name: content["counters"].get(name, 0) + n for name, n in counters.items()}
        kept = content["buckets"] | new
        self.manifest.commit(version, {"batch": batch_id, "buckets": kept, "of": content["of"], "counters": total})

    def vacuum(self) -> None:
        """Keeps what the last batch left and what it started from."""
        versions = self.manifest.versions()
        if versions:
            last = self.manifest.load(versions[-1])["batch"]
            earlier = [v for v in versions if self.manifest.load(v)["batch"] < last]
            self.manifest.vacuum([*earlier[-1:], versions[-1]], lambda content: set(content["buckets"].values()))
