"""Tables that are replaced by a commit: readers see the old rows until the new ones are whole.

A table folder holds one folder of Parquet files for each version and a small list of commits. A write goes
to a version folder of its own; only when it has ended is one row appended to the commits, by a
single renamed file. So a write that fails midway leaves the old version readable, a reader goes on with
the version it began with, and a table can be replaced by rows read from itself.

    {path}/versions/{version}/*.parquet
    {path}/commits/*.json               seq, version, n_rows, note
"""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lakestrata.operators.quality import observe_rows

COMMITS = "seq bigint, version string, n_rows bigint, note string"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, asked of its own file system (a failed read would log an error)."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        try:
            return spark.read.schema("x string").json(path) is not None
        except AnalysisException:
            return False
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(sc._jsc.hadoopConfiguration()).exists(at)


def commits(spark: SparkSession, path: str) -> DataFrame | None:
    """The commits of a table, one row for each version; ``None`` if it isn't kept by commits."""
    folder = f"{path.rstrip('/')}/commits"
    return spark.read.schema(COMMITS).json(folder) if path_exists(spark, folder) else None


def current_version(spark: SparkSession, path: str) -> Row | None:
    """The last commit (``seq version note``). Of two writers that committed the same number, the greater name holds."""
    listed = commits(spark, path)
    return None if listed is None else listed.agg(F.max(F.struct("seq", "version", "note")).alias("last")).first().last


def resolve(spark: SparkSession, path: str) -> str:
    """The folder to read: that of the current version, or ``path`` itself if the table isn't kept by commits."""
    if re.search(r"[*?\[\]{}]", path):
        return path
    last = current_version(spark, path)
    return f"{path.rstrip('/')}/versions/{last.version}" if last else path


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the version that is current now; a later replace doesn't change this frame."""
    last = current_version(spark, path)
    if last is None:
        raise FileNotFoundError(f"no committed version under {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/versions/{last.version}")


def replace_committed(df: DataFrame, path: str, max_records_per_file: int | None = None, note: str | None = None) -> int:
    """Replace the table at ``path`` by ``df``; returns the number of rows (counted by the write).

    ``df`` may read the table itself. ``note`` is kept with the commit (what the rows were made from, say). If the write fails, its error is raised and nothing has changed.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    last = current_version(spark, root)
    version = uuid.uuid4().hex
    counted, seen = observe_rows(df, f"rows-{version}")
    writer = counted.write
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.parquet(f"{root}/versions/{version}")
    n_rows = int(seen.get["n_rows"])
    spark.createDataFrame([(last.seq + 1 if last else 1, version, n_rows, note)], COMMITS).coalesce(1).write.mode("append").json(f"{root}/commits")
    return n_rows


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Empty the folders of all committed versions but the last ``keep``; returns their names.

    Readers that still use such a version lose it. Folders of failed writes are not listed and stay.
    """
    root, listed = path.rstrip("/"), commits(spark, path)
    if listed is None:
        return []
    old = [r.version for r in listed.orderBy(F.desc("seq"), F.desc("version")).collect()[max(1, keep):]]  # a row for each version
    for version in old:
        folder = f"{root}/versions/{version}"
        empty = spark.createDataFrame([], spark.read.parquet(folder).schema)
        empty.write.mode("overwrite").parquet(folder)
    return old
