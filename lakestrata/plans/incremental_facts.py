"""The latest movements of each (unit, case) kept day by day.

The newest time of a group and the number of movements at that time can be merged: of two days' partial results the
later time wins, and equal times add up. Each landed day leaves its own partial result and a merged
state, replaced by a commit that notes which partial results it holds. A new day costs its own rows and one
merge with the state; a day taken again costs a merge of the partial results, never the
movements of other days.

    {path}/days/{yyyyMMdd}/{version}/*.parquet     partial results
    {path}/state/                                  committed: __unit, __case, __ts, __n
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakestrata.plans.facts import DEFAULT_SPEC, StarSpec, latest_movements
from lakestrata.sinks.committed import current_version, read_current, replace_committed
from lakestrata.sources.layout import date_key


def merge_latest(partials: DataFrame) -> DataFrame:
    """Partial results of the same groups merged: the latest time and all movements at it."""
    per_time = partials.groupBy("__unit", "__case", "__ts").agg(F.sum("__n").alias("__n"))
    latest = per_time.groupBy("__unit", "__case").agg(F.max("__ts").alias("__ts"), F.max_by("__n", "__ts").alias("__n"))
    return latest.select("__unit", "__case", "__ts", F.col("__n").cast("bigint").alias("__n"))


def _held(spark: SparkSession, path: str) -> dict[str, str]:
    """The days in the state and the version of each one's partial result (a line for each day)."""
    last = current_version(spark, f"{path.rstrip('/')}/state")
    return json.loads(last.note) if last else {}


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """``__unit __case __ts __n`` of all days taken so far."""
    return read_current(spark, f"{path.rstrip('/')}/state")


def merge_day(movements: DataFrame, path: str, day: str, spec: StarSpec = DEFAULT_SPEC) -> DataFrame:
    """Take one day's movements (all of them) into the state and return it.

    A day that was taken before is replaced, and the state changes by one commit, so a run that is
    repeated, or stopped anywhere, counts no movement twice and loses none. One writer at a time.
    """
    spark, root, day, version = movements.sparkSession, path.rstrip("/"), date_key(day), uuid.uuid4().hex
    latest_movements(movements, spec).write.parquet(f"{root}/days/{day}/{version}")
    held = _held(spark, root)
    taken = held | {day: version}
    if held and day not in held:
        parts = read_state(spark, root).unionByName(spark.read.parquet(f"{root}/days/{day}/{version}"))
    else:
        parts = spark.read.parquet(*[f"{root}/days/{d}/{v}" for d, v in sorted(taken.items())])
    replace_committed(merge_latest(parts), f"{root}/state", note=json.dumps(taken, sort_keys=True))
    return read_state(spark, root)


def merge_stream(spark: SparkSession, landed: str, schema: StructType, read_day: Callable[[str], DataFrame], path: str,
                 spec: StarSpec = DEFAULT_SPEC, file_type: str = "parquet", checkpoint: str | None = None) -> StreamingQuery:
    """Take every day for which files have landed since the last run (``availableNow``).

    The stream finds the days (a ``/yyyyMMdd/`` folder in the path pattern ``landed``); each is read whole by
    ``read_day`` and merged, so late files of a day and a batch that is run again are counted once.
    """
    files = spark.readStream.format(file_type).schema(schema).load(landed).select(F.regexp_extract("_metadata.file_path", r"/([0-9]{8})/", 1).alias("day"))

    def take(batch: DataFrame, _: int) -> None:
        for r in batch.where("day <> ''").distinct().orderBy("day").collect():  # a name for each day
            merge_day(read_day(r.day), path, r.day, spec)

    return (files.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint or f"{path.rstrip('/')}/checkpoint")
            .trigger(availableNow=True).start())
