"""Reproducible random split by hashing the row key (no shuffle, no driver state).

Unlike ``randomSplit``, a row's side depends only on its key and the seed, so it
does not change when the input is repartitioned or a task is retried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 42
BUCKETS = 1_000_000


def hash_bucket(key: Column, seed: int = SEED) -> Column:
    """0..999,999 from a key of any type: the first 32 bits of md5 over its text and the seed. A null key is the text
    "null", so that rows without a key are on one side."""
    text = F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(BUCKETS))


def hash_split(df: DataFrame, key: Column, train_fraction: float = 0.8, seed: int = SEED) -> DataFrame:
    cut = int(round(train_fraction * BUCKETS))
    return df.withColumn("split", F.when(hash_bucket(key, seed) < cut, "train").otherwise("test"))
