"""File sizes of streaming sinks.

A streaming sink adds one file per task, date and micro-batch. ``compact_closed`` reads the files of closed date partitions that it has not read
before, and publishes these partitions in files of the session's advisory partition size through ``published`` (fresh folders, then one pointer
file). The list of files that a version holds is part of that version, so one step makes rows move from the small files to the large ones:
``read_compacted`` takes the published partitions and those files of the sink alone that the same pointer does not list. A row that comes late to a
closed date lies in a new file and is read there until the next compaction merges it. The sink's folder is never written here: its writer
and its readers go on, and a job that fails leaves the version before.

File names go through the driver, as they do in any listing by Spark; rows do not. Partition values are compared as text, which orders ISO
dates; a row without a date is in no closed partition. ``remove_sources`` deletes small files that nobody reads any more: those that already
the version before the newest lists, and that the sink's own log, if it keeps one, has let go (option ``retention`` of the sink)."""

from __future__ import annotations

import json
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from zonecast.operators import published as P
from zonecast.operators.tables import delete_path, table_exists

FILES = "_files"
LOG = "_spark_metadata"


def sink_files(spark: SparkSession, source: str, schema: StructType) -> list[str]:
    """Data files of the sink, relative to its folder; of a file sink, those that its log has committed."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source)
    base = unquote(root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(root).toUri().getPath()).rstrip("/") + "/"
    return [unquote(f).split(base, 1)[1] for f in spark.read.schema(schema).parquet(source).inputFiles()]


def _value(name: str, column: str) -> str | None:
    """A file's partition value; None in the null partition."""
    for part in name.split("/")[:-1]:
        if part.startswith(f"{column}="):
            value = part.removeprefix(f"{column}=")
            return None if value == "__HIVE_DEFAULT_PARTITION__" else value
    return None


def _listed(spark: SparkSession, target: str, live: dict | None) -> set[str]:
    """Files of the sink that a version holds."""
    if live is None:
        return set()
    return {r.name for r in spark.read.schema("name string").parquet(f"{target}/{live['folders'][FILES]}").collect()}


def _read(spark: SparkSession, source: str, schema: StructType, names: list[str]) -> DataFrame:
    if not names:
        return spark.createDataFrame([], schema)
    # ``names`` came from the log or listing; the base path brings the partition columns
    return spark.read.schema(schema).option("basePath", source).parquet(*[f"{source}/{n}" for n in names])


def _parts(live: dict | None) -> list[str]:
    return [p for p in (live or {"folders": {}})["folders"] if p != FILES]


def read_compacted(spark: SparkSession, source: str, target: str, schema: StructType) -> DataFrame:
    """All rows of the sink, each once: published partitions, and the files that their version does not list."""
    source, target = source.rstrip("/"), target.rstrip("/")
    live = P.pointer(spark, target)
    done = _listed(spark, target, live)
    rest = _read(spark, source, schema, sorted(n for n in sink_files(spark, source, schema) if n not in done)).select(*schema.names)
    if live is None:
        return rest
    return P.read_published(spark, target, live["number"], _parts(live)).select(*schema.names).unionByName(rest)


def compact_closed(spark: SparkSession, source: str, target: str, schema: StructType, before: str, column: str = "event_date") -> int | None:
    """Publish the partitions below ``before`` (the date of the stream's watermark) that have unread files; the version's number, None if there is
    nothing to do. One compaction of a table runs at a time; a second one fails at its last step."""
    source, target = source.rstrip("/"), target.rstrip("/")
    live = P.pointer(spark, target)
    done = _listed(spark, target, live)
    there = sink_files(spark, source, schema)
    new = sorted(n for n in there if n not in done and (v := _value(n, column)) is not None and v < before)
    if not new:
        return None
    rows = _read(spark, source, schema, new).select(*schema.names)
    touched = {r["p"]: r["v"] for r in rows.select(P._part([column]).alias("p"), P._values([column]).alias("v")).distinct().collect()}
    old = [p for p in touched if p in _parts(live)]
    if old:
        rows = P.read_published(spark, target, live["number"], old).select(*schema.names).unionByName(rows)
    folders = P._write_generation(rows, target, [column])
    # names that the sink has let go need no entry: nobody finds them
    held = sorted((done & set(there)) | set(new))
    listing = next(iter(folders.values())).rsplit("/", 1)[0] + f"/{P.PART}={FILES}"
    spark.createDataFrame([(n,) for n in held], "name string").coalesce(1).write.mode("errorifexists").parquet(f"{target}/{listing}")
    live = live or {"number": -1, "folders": {}, "values": {}, "partition_by": [column], "schema": json.loads(schema.json())}
    number = live["number"] + 1
    P._publish(spark, target, live | {"number": number, "folders": live["folders"] | folders | {FILES: listing},
                                      "values": live["values"] | touched})
    P.clean(spark, target)
    return number


def remove_sources(spark: SparkSession, source: str, target: str) -> int:
    """Delete small files that the version before the newest holds already, so that a reader of that version finds all it reads; files that the
    sink's log still names stay. The number of deleted files."""
    source, target = source.rstrip("/"), target.rstrip("/")
    live = P.pointer(spark, target)
    if live is None or live["number"] == 0:
        return 0
    gone = _listed(spark, target, P.pointer(spark, target, live["number"] - 1))
    if table_exists(spark, f"{source}/{LOG}"):
        gone -= set(sink_files(spark, source, StructType.fromJson(live["schema"])))
    found = [n for n in gone if table_exists(spark, f"{source}/{n}")]
    for name in found:
        delete_path(spark, f"{source}/{name}")
    return len(found)
