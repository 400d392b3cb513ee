"""Start the bronze and silver streams for the three entities and supervise them."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from zonecast.streaming.streams import Trigger, start_bronze, start_silver

ENTITIES = ("rides", "drivers", "payments")


def start_all(spark: SparkSession, sources: dict[str, str], root: str, trigger: Trigger = Trigger(),
              kafka_servers: str | None = None) -> list[StreamingQuery]:
    """Six queries: source -> bronze and bronze -> silver per entity. ``sources`` maps an
    entity to a folder of JSON-lines files (or to a topic when ``kafka_servers`` is set)."""
    queries = []
    for e in ENTITIES:
        bronze, silver = f"{root}/bronze/{e}", f"{root}/silver/{e}"
        if kafka_servers:
            queries.append(start_bronze(spark, e, bronze, f"{root}/_checkpoints/bronze_{e}",
                                        kafka_servers=kafka_servers, topic=sources[e], trigger=trigger))
        else:
            queries.append(start_bronze(spark, e, bronze, f"{root}/_checkpoints/bronze_{e}",
                                        source_path=sources[e], trigger=trigger))
    for q in queries:  # with availableNow, silver starts once bronze has landed
        if trigger.available_now and not trigger.processing_time:
            q.awaitTermination()
    for e in ENTITIES:
        queries.append(start_silver(spark, e, f"{root}/bronze/{e}", f"{root}/silver/{e}",
                                    f"{root}/_checkpoints/silver_{e}", trigger=trigger))
    return queries


def supervise(queries: list[StreamingQuery], poll_seconds: float = 30.0, max_polls: int | None = None,
              log=print) -> list[dict]:
    """Report active queries every poll; stop all on interrupt. Returns final status rows."""
    polls = 0
    try:
        while any(q.isActive for q in queries) and (max_polls is None or polls < max_polls):
            time.sleep(poll_seconds)
            polls += 1
            log(f"active streaming queries: {sum(q.isActive for q in queries)}/{len(queries)}")
    except KeyboardInterrupt:
        pass
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
    out = []
    for q in queries:
        p = q.lastProgress or {}
        out.append({"name": q.name, "active": q.isActive, "batch_id": int(p.get("batchId", -1)),
                    "input_rows": int(p.get("numInputRows", 0)), "exception": str(q.exception() or "")})
    return out
