from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


@pytest.fixture
def docs(spark):
    """A documents frame from (doc_id, text) pairs."""
    def make(rows):
        return spark.createDataFrame(list(rows), DOC)
    return make


class Words:
    """Invented words from a fixed sequence, so that tests need no data files."""

    def __init__(self, seed: int):
        self.state = seed

    def pick(self, n: int) -> int:
        self.state = (self.state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        return (self.state >> 33) % n

    def word(self) -> str:
        parts = ["ka", "lo", "mi", "tu", "re", "sa", "ne", "po", "vi", "du", "é", "ß"]
        return "".join(parts[self.pick(len(parts))] for _ in range(2 + self.pick(3)))

    def text(self, n: int) -> str:
        return " ".join(self.word() for _ in range(n))


@pytest.fixture
def words():
    return Words(7)
