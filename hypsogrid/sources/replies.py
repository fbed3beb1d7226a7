"""A store of replies by the content of their requests: what has been answered once is not asked again.

Entries are (key, body, sha256), in one folder for each batch of fetches. A batch is written aside and moved into place
when it is complete, so a task or a job that runs again leaves no half entries, and nothing that is there is changed.
An entry whose body no longer has its digest is set aside: it counts as missing, and its key is fetched anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import storage

ENTRY = "key string, body binary, sha256 string"


@dataclass(frozen=True)
class ReplyStore:
    path: str

    def entries(self, spark: SparkSession) -> DataFrame:
        """All entries with their batch; none if the store is new."""
        if not storage.exists(spark, self.path):
            return spark.createDataFrame([], ENTRY + ", batch string")
        return spark.read.schema(ENTRY + ", batch string").parquet(self.path)

    def _good(self, spark: SparkSession, keys: DataFrame | None) -> DataFrame:
        """Entries that are as they were written, of `keys` alone if given: others are neither checked nor moved."""
        found = self.entries(spark)
        found = found if keys is None else found.join(keys.select("key").distinct(), "key", "left_semi")
        return found.where(F.sha2("body", 256) == F.col("sha256"))

    def sound(self, spark: SparkSession, keys: DataFrame | None = None) -> DataFrame:
        """key and body of sound entries, all or those of `keys`; of several one."""
        return self._good(spark, keys).groupBy("key").agg(F.min_by("body", F.struct("batch", "sha256")).alias("body"))

    def corrupt(self, spark: SparkSession) -> DataFrame:
        """key and batch of entries that are not, and do not count."""
        return self.entries(spark).where(~F.coalesce(F.sha2("body", 256) == F.col("sha256"), F.lit(False))).select("key", "batch")

    def missing(self, wanted: DataFrame) -> DataFrame:
        """wanted (key, and more) of keys without a sound entry, each key once. Bodies are read, not shuffled."""
        return wanted.dropDuplicates(["key"]).join(self._good(wanted.sparkSession, wanted).select("key"), "key", "left_anti")

    def append(self, replies: DataFrame) -> str:
        """Commits a batch of (key, body); its name."""
        spark, batch = replies.sparkSession, uuid.uuid4().hex
        staged = f"{self.path}/_staged-{batch}"  # readers pass over names with an underscore
        try:
            replies.select("key", "body", F.sha2("body", 256).alias("sha256")).write.parquet(staged)
            storage.swap(spark, staged, f"{self.path}/batch={batch}")
        finally:
            storage.remove(spark, staged)
        return batch

    def complete(self, wanted: DataFrame, fetch: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]) -> DataFrame:
        """key and body for all of wanted (key, and what `fetch` needs); what is missing is fetched, by as many tasks as
        there are shuffle partitions, and committed first."""
        spark = wanted.sparkSession
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        new = self.missing(wanted).repartition(tasks, "key").mapInPandas(fetch, "key string, body binary")
        self.append(new)
        return self.sound(spark, wanted)
