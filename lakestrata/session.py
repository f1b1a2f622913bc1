"""Session helpers.

The library never builds its own session for production work: every function takes the
caller's ``SparkSession``. ``local_session`` exists for tests, the bench and the smoke
entry only. ``shared_dir`` hands out folders under the cluster-shared checkpoint folder,
which is the only place the library writes scratch data.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the plans built here (AQE re-plans joins from runtime sizes and
# splits skewed shuffle partitions; the window group limit keeps top-k pruning map-side).
SCALE_CONFS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}


def local_session(app: str = "lakestrata", cpus: int | str = "*", shuffle_partitions: int = 8,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**SCALE_CONFS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        return spark.conf.get(key, None) or None
    except Exception:  # noqa: BLE001 - a key the session does not expose
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session names none (a local test run) is a folder of our own set.
    """
    root = _conf(spark, "spark.checkpoint.dir")
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        sc = None
    if sc is not None:
        root = root or sc.getConf().get("spark.checkpoint.dir", None)
        current = sc.getCheckpointDir()
        if not root and current:
            # getCheckpointDir appends a per-application uuid folder; use its parent.
            root = current.rstrip("/").rsplit("/", 1)[0]
        if not root and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        if not root:
            root = tempfile.mkdtemp(prefix="lakestrata-ckpt-")
        if not current:
            sc.setCheckpointDir(root)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return root


def session_key(spark: SparkSession) -> str:
    """An id of the running application (for per-session caches)."""
    return _conf(spark, "spark.app.id") or str(id(spark))


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the shared checkpoint root, unique per call."""
    root = checkpoint_root(spark).rstrip("/")
    return "/".join([root, "lakestrata", *parts, uuid.uuid4().hex])


def staged(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared scratch folder and read again: what several jobs
    use is computed once, and a lost executor costs a re-read."""
    path = shared_dir(df.sparkSession, "staged", name)
    if (copies := _COPIES.get()) is not None:
        copies.append(path)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_COPIES: ContextVar[list[str] | None] = ContextVar("copies", default=None)


@contextmanager
def copies_removed(spark: SparkSession) -> Iterator[None]:
    """What ``staged`` writes inside (in this thread) is removed at the end: nothing may read it later."""
    copies: list[str] = []
    token = _COPIES.set(copies)
    try:
        yield
    finally:
        _COPIES.reset(token)
        try:
            sc = spark.sparkContext
        except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext: the copies stay
            copies = []
        for path in copies:
            with suppress(Exception):  # a copy that stays is no failure
                at = sc._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


#: Shuffle files of a run go when it ends; else they stay until the driver happens to collect its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FREEING: dict[int, list] = {}  # session's id -> session, open blocks
_FREEING_LOCK = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes inside leave no shuffle files, unless the session itself sets ``FREE_SHUFFLES``. Blocks of
    several threads may overlap; the last to end takes the setting back."""
    with _FREEING_LOCK:
        opened = _FREEING.get(id(spark))
        own = opened is not None or _conf(spark, FREE_SHUFFLES) is None
        if own:
            opened = _FREEING.setdefault(id(spark), [spark, 0])
            opened[1] += 1
            spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if own:
            with _FREEING_LOCK:
                opened[1] -= 1
                if not opened[1]:
                    del _FREEING[id(spark)]
                    spark.conf.unset(FREE_SHUFFLES)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for local-only helpers (tests)."""
    return path[len("file:"):] if path.startswith("file:") else path
