"""J1 on storage, published in one step: partitions in generation folders, named by a small pointer file.

    <path>/generations/<generation>/__part=<digest>/...   files of one partition, with all columns in them
    <path>/pointers/<number>.json                       which folder holds each partition, and the table's schema

An upsert writes the merged partitions into a fresh generation and then one pointer file, under a temporary name first. A reader takes the pointer
with the highest number and reads the folders that it names. So a job that fails at any point before the rename leaves the table as it was, and
a reader that began earlier keeps its files: folders go only when neither of the two newest pointers names them. Partitions that the source
does not touch are neither read nor written. Single writer; a second one fails at the rename, as the number is taken."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from zonecast.operators.tables import assert_unique_keys, delete_path, merge_upsert

WHOLE = "all"
PART = "__part"


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, root, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    _, root, files = _hadoop(spark, path)
    return [s.getPath().getName() for s in files.listStatus(root)] if files.exists(root) else []


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in _names(spark, f"{path}/pointers") if n.endswith(".json") and n[0].isdigit())


def pointer(spark: SparkSession, path: str, number: int | None = None) -> dict | None:
    """The newest pointer, or that of a number: {"number", "schema", "partition_by", "folders": {part: folder}, "values": {part: json}}."""
    numbers = _numbers(spark, path)
    if not numbers:
        return None
    jvm, file, files = _hadoop(spark, f"{path}/pointers/{number if number is not None else numbers[-1]:012d}.json")
    stream = files.open(file)
    try:
        return json.loads(bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
    finally:
        stream.close()


def _publish(spark: SparkSession, path: str, content: dict) -> None:
    """The one step that changes the table."""
    jvm, folder, files = _hadoop(spark, f"{path}/pointers")
    files.mkdirs(folder)
    temporary = jvm.org.apache.hadoop.fs.Path(f"{path}/pointers/_new-{uuid.uuid4().hex}")
    stream = files.create(temporary)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    final = jvm.org.apache.hadoop.fs.Path(f"{path}/pointers/{content['number']:012d}.json")
    if files.exists(final) or not files.rename(temporary, final):
        raise RuntimeError(f"another writer published version {content['number']} of {path}")


def _part(partition_by: list[str]) -> Column:
    """Name of a row's partition: a digest, so that null, text and numbers never meet in a folder name."""
    return F.md5(_values(partition_by)) if partition_by else F.lit(WHOLE)


def _values(partition_by: list[str]) -> Column:
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in partition_by]), {"ignoreNullFields": "false"})


def read_published(spark: SparkSession, path: str, number: int | None = None, parts: list[str] | None = None) -> DataFrame:
    """The table as its newest pointer (or that of ``number``) names it; ``parts``: only these partitions."""
    live = pointer(spark, path, number)
    if live is None:
        raise FileNotFoundError(f"no published table at {path}")
    schema = StructType.fromJson(live["schema"])
    folders = sorted(f"{path}/{f}" for p, f in live["folders"].items() if parts is None or p in parts)
    if not folders:
        return spark.createDataFrame([], schema)
    # the files hold all columns: nothing is inferred from folder names
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*folders)


def _write_generation(df: DataFrame, path: str, partition_by: list[str]) -> dict[str, str]:
    """Write a fresh generation; {part: folder below ``path``} of the partitions that have rows."""
    spark = df.sparkSession
    generation = f"generations/{uuid.uuid4().hex}"
    frame = df.withColumn(PART, _part(partition_by))
    (frame.hint("rebalance", PART).write.mode("errorifexists").partitionBy(PART).parquet(f"{path}/{generation}"))
    return {n.removeprefix(f"{PART}="): f"{generation}/{n}" for n in _names(spark, f"{path}/{generation}") if n.startswith(f"{PART}=")}


def clean(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove pointers but the ``keep`` newest, and folders that none of those names."""
    numbers = _numbers(spark, path)
    named = {f for n in numbers[-keep:] for f in pointer(spark, path, n)["folders"].values()}
    for number in numbers[:-keep]:
        delete_path(spark, f"{path}/pointers/{number:012d}.json")
    for generation in _names(spark, f"{path}/generations"):
        folders = [f"generations/{generation}/{n}" for n in _names(spark, f"{path}/generations/{generation}") if n.startswith(f"{PART}=")]
        gone = [f for f in folders if f not in named]
        for folder in [f"generations/{generation}"] if len(gone) == len(folders) else gone:
            delete_path(spark, f"{path}/{folder}")


def publish_upsert(spark: SparkSession, source: DataFrame, path: str, keys: list[str], partition_by: list[str] | None = None,
                   check_unique: bool = True) -> int:
    """Merge ``source`` into the table (created if absent) and give the number of the pointer that was published.

    ``partition_by`` must be among ``keys``: otherwise a key that moves to another partition would leave its old row behind. The source is
    computed once, into a staging folder; the partitions it touches (one name each on the driver) are the only ones read and written."""
    partition_by = list(partition_by or [])
    if not set(partition_by) <= set(keys):
        raise ValueError(f"partition columns {partition_by} must be among the keys {keys}")
    if PART in source.columns:
        raise ValueError(f"a published table cannot have a column {PART!r}")
    path = path.rstrip("/")
    staging = f"{path}/staging-{uuid.uuid4().hex}"
    try:
        source.write.mode("errorifexists").parquet(staging)
        incoming = spark.read.schema(source.schema).parquet(staging)
        if check_unique:
            assert_unique_keys(incoming, keys)
        live = pointer(spark, path) or {"number": -1, "folders": {}, "values": {}, "partition_by": partition_by,
                                        "schema": json.loads(source.schema.json())}
        if live["partition_by"] != partition_by:
            raise ValueError(f"the table is partitioned by {live['partition_by']}")
        values = _values(partition_by) if partition_by else F.lit("{}")
        touched = {r["p"]: r["v"] for r in incoming.select(_part(partition_by).alias("p"), values.alias("v")).distinct().collect()}
        old = [p for p in touched if p in live["folders"]]
        merged = incoming if not old else merge_upsert(read_published(spark, path, live["number"], old), incoming, keys)
        folders = _write_generation(merged, path, partition_by)
        number = live["number"] + 1
        _publish(spark, path, live | {"number": number, "folders": live["folders"] | folders, "values": live["values"] | touched})
    finally:
        delete_path(spark, staging)
    clean(spark, path)
    return number
