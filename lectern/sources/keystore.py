"""Tables stored in ranges of a key, and the rows of a table of asked keys out of them.

``write`` sorts a table by its key and cuts it into zones of about ``rows`` rows; a zone
is a folder of its own, and a small table tells each zone's first and last key. A key of a
third of all rows runs over many zones. ``pick`` finds the zones of the asked keys in that
table and joins the store on zone and key. While the asked keys are few enough to be sent
out, which their written size tells, Spark hands the zones to the scan as a run-time
filter and lists and opens no other folder; beyond that it is a plain join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle

ROWS = 50_000


def write(df: DataFrame, path: str, key: str, order: tuple[str, ...] = (), rows: int = ROWS) -> None:
    """Store ``df`` by ``key``; within a key rows are in ``order``. Rows without a key are left out."""
    held = settle(df.where(F.col(key).isNotNull()), "unsorted")
    zones = max(1, math.ceil(held.count() / rows))
    ranged = held.repartitionByRange(zones, key, *order).sortWithinPartitions(key, *order)
    zoned = ranged.withColumn("zone", F.spark_partition_id())
    zoned.write.partitionBy("zone").parquet(f"{path}/rows")
    zoned.limit(0).write.parquet(f"{path}/columns")  # the columns, also of a table without rows
    stored = _rows(df.sparkSession, path).select(key, "zone")
    stored.groupBy("zone").agg(F.min(key).alias("least"), F.max(key).alias("most")).coalesce(1).write.parquet(f"{path}/zones")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/columns").schema).parquet(f"{path}/rows")


class Store:
    """A stored table; an empty one has no rows of any kind."""

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.key = spark, key
        self.rows, self.zones = _rows(spark, path), spark.read.parquet(f"{path}/zones")

    def _met(self, asked: DataFrame, low: Column, high: Column) -> DataFrame:
        """``asked`` with the ``zone`` of every zone that may hold keys from ``low`` to ``high``."""
        return asked.join(F.broadcast(self.zones), (F.col("least") <= high) & (F.col("most") >= low)).drop("least", "most")

    def pick(self, asked: DataFrame, column: str | None = None) -> DataFrame:
        """The stored rows whose key stands in a column of ``asked``, each once."""
        wanted = F.col(column or self.key).alias(self.key)
        keys = asked.select(wanted).where(F.col(self.key).isNotNull()).distinct()
        zoned = settle(self._met(keys, F.col(self.key), F.col(self.key)), "asked")
        # The filter on the zone is always true; it tells the optimizer that few are asked.
        return self.rows.join(zoned.where("zone >= 0"), ["zone", self.key], "left_semi").drop("zone")

    def zones_of(self, asked: DataFrame, column: str | None = None) -> DataFrame:
        """Numbers of the zones that ``pick`` reads."""
        keys = asked.select(F.col(column or self.key).alias("_asked")).distinct()
        return self._met(keys, F.col("_asked"), F.col("_asked")).select("zone").distinct()
