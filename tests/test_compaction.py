"""Small files of a sink become large ones; readers see each row once, whatever happens between."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import types as T

from zonecast.operators import compaction as CO
from zonecast.operators import published as P
from zonecast.session import work_dir

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("event_date", T.DateType())])


def add(spark, path, rows):
    """One micro-batch: a file per row's date and task."""
    frame = spark.createDataFrame(rows, "id bigint, day string").selectExpr("id", "cast(day as date) as event_date")
    frame.repartition(2).write.mode("append").partitionBy("event_date").parquet(path)


def rows_of(frame):
    return Counter((r.id, str(r.event_date)) for r in frame.collect())


def folder(spark):
    root = work_dir(spark, "compaction")
    return f"{root}/sink", f"{root}/compacted"


def test_closed_partitions_shrink_and_rows_stay(spark):
    sink, target = folder(spark)
    want = Counter()
    for batch in range(6):
        rows = [(batch * 10 + i, day) for i, day in enumerate(["2024-01-01", "2024-01-02", "2024-01-03", None])] + [(7, "2024-01-01")]
        add(spark, sink, rows)
        want.update((i, str(d)) for i, d in rows)
    assert rows_of(CO.read_compacted(spark, sink, target, SCHEMA)) == want  # nothing compacted yet
    before = len(CO.read_compacted(spark, sink, target, SCHEMA).inputFiles())
    assert CO.compact_closed(spark, sink, target, SCHEMA, "2024-01-03") == 0
    found = CO.read_compacted(spark, sink, target, SCHEMA)
    assert rows_of(found) == want
    files = [f for f in found.inputFiles() if "/generations/" in f]
    assert len(files) == 2 and len(found.inputFiles()) < before
    # the open date and the rows without one are read where they are
    assert all("2024-01-03" in f or "__HIVE" in f for f in found.inputFiles() if "/generations/" not in f)
    assert CO.compact_closed(spark, sink, target, SCHEMA, "2024-01-03") is None


def test_late_rows_repeats_and_removal(spark):
    sink, target = folder(spark)
    add(spark, sink, [(1, "2024-01-01"), (1, "2024-01-01"), (2, "2024-01-02")])
    CO.compact_closed(spark, sink, target, SCHEMA, "2024-01-02")
    early = CO.read_compacted(spark, sink, target, SCHEMA)  # planned now, run later
    add(spark, sink, [(3, "2024-01-01"), (4, "2024-01-02")])
    want = Counter({(1, "2024-01-01"): 2, (2, "2024-01-02"): 1, (3, "2024-01-01"): 1, (4, "2024-01-02"): 1})
    assert rows_of(CO.read_compacted(spark, sink, target, SCHEMA)) == want
    assert CO.remove_sources(spark, sink, target) == 0  # no version before
    assert CO.compact_closed(spark, sink, target, SCHEMA, "2024-01-03") == 1
    assert rows_of(CO.read_compacted(spark, sink, target, SCHEMA)) == want
    assert CO.remove_sources(spark, sink, target) > 0
    assert rows_of(CO.read_compacted(spark, sink, target, SCHEMA)) == want
    assert rows_of(early) == Counter({(1, "2024-01-01"): 2, (2, "2024-01-02"): 1})


def test_a_failure_before_the_last_step_changes_nothing(spark, monkeypatch):
    sink, target = folder(spark)
    add(spark, sink, [(1, "2024-01-01"), (2, None)])
    CO.compact_closed(spark, sink, target, SCHEMA, "2024-02-01")
    add(spark, sink, [(3, "2024-01-01")])

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(P, "_publish", fail)
        with pytest.raises(OSError):
            CO.compact_closed(spark, sink, target, SCHEMA, "2024-02-01")
    want = Counter({(1, "2024-01-01"): 1, (2, "None"): 1, (3, "2024-01-01"): 1})
    assert rows_of(CO.read_compacted(spark, sink, target, SCHEMA)) == want
    assert CO.compact_closed(spark, sink, target, SCHEMA, "2024-02-01") == 1
    assert rows_of(CO.read_compacted(spark, sink, target, SCHEMA)) == want


def test_files_that_a_sink_log_names_stay(spark):
    from zonecast.streaming.streams import Trigger

    sink, target = folder(spark)
    source = f"{target}-in"
    spark.range(0).write.parquet(f"{source}")
    for start in (0, 10):
        spark.range(start, start + 10).write.mode("append").parquet(source)
        stream = spark.readStream.schema("id bigint").parquet(source).selectExpr("id", "date'2024-01-01' as event_date")
        Trigger().apply(stream.writeStream.format("parquet").partitionBy("event_date").option("checkpointLocation", f"{target}-chk")).start(sink).awaitTermination()
        CO.compact_closed(spark, sink, target, SCHEMA, "2024-01-02")
    assert P.pointer(spark, target)["number"] == 1
    assert CO.remove_sources(spark, sink, target) == 0
    assert sorted(r.id for r in CO.read_compacted(spark, sink, target, SCHEMA).collect()) == list(range(20))
    assert spark.read.schema(SCHEMA).parquet(sink).count() == 20  # the sink's own readers see what they saw
