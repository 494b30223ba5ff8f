"""Vectors for the embedding operators: which take part, and equal ones as one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null or zero, all components finite numbers."""
    big = F.lit(float("inf"))
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < big), F.lit(False)))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(values: pa.Array) -> np.ndarray:
    """Lists of one length as rows of double precision."""
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = values.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths != lengths[0]).any():
        raise ValueError("vectors of one table must have one length")
    return flat.reshape(len(lengths), -1)


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """Equal usable vectors as one: ``(n, embedding, least, copies)``, written once.

    ``n`` is unique, ``least`` the smallest id. Tasks count before they shuffle.
    """
    held = vectors.where(usable(F.col("embedding")))
    counts = held.groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    return settle(counts.withColumn("n", F.monotonically_increasing_id()), "vectors")


def least_ids(vectors: DataFrame, keep: int) -> DataFrame:
    """Equal usable vectors as one with their ``keep`` smallest ids: ``(n, embedding, ids)``.

    Ranks up to ``keep`` are cut in every task before the shuffle, so a vector that most
    rows have gives ``keep`` rows a task. No other id can be among the nearest ``keep``.
    """
    held = vectors.where(usable(F.col("embedding"))).select("vec_id", "embedding")
    order = Window.partitionBy("embedding").orderBy(F.col("vec_id").asc_nulls_last())
    first = held.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)
    ids = first.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    return settle(ids.withColumn("n", F.monotonically_increasing_id()), "vectors")
