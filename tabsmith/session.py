"""SparkSession construction and lineage checkpoints.

On a cluster the session comes from the launcher; we only read
``spark.checkpoint.dir`` from it, and a cluster session without one is an
error. A local folder is made only in local mode with the setting absent, and
only when something is about to be written there.
"""

from __future__ import annotations

import os
import tempfile
import weakref
from collections.abc import Callable
from contextvars import ContextVar, copy_context

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # long sessions run hundreds of small jobs: keep little listener history on the heap
    "spark.sql.ui.retainedExecutions": "50",
    "spark.ui.retainedJobs": "100",
    "spark.ui.retainedStages": "100",
}


def get_spark(master: str | None = None, app: str = "tabsmith",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory; makes a local one only if unset and the master is in this process."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="tabsmith-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return local


_global: list[DataFrame] = []
_scope: ContextVar[list[DataFrame] | None] = ContextVar("held_frames", default=None)


def hold(df: DataFrame) -> DataFrame:
    """Keep a frame that several passes read (memory, then disk; recomputed if an executor is lost).

    Within ``held_with`` it is kept as long as that block's result; otherwise until ``release``.
    """
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    frames = _scope.get()
    (_global if frames is None else frames).append(df)
    return df


def _let_go(frames: list[DataFrame]) -> None:
    while frames:
        try:
            frames.pop().unpersist()
        except Exception:  # noqa: BLE001  the session may have ended before the result did
            frames.clear()


def held_with(make: Callable[[], DataFrame]) -> DataFrame:
    """Result of ``make``; the frames held while making it are let go when the result is no longer referred to."""
    frames: list[DataFrame] = []
    token = _scope.set(frames)
    try:
        out = make()
    finally:
        _scope.reset(token)
    weakref.finalize(out, _let_go, frames)
    return out


def release() -> None:
    """Let go of every frame that ``hold`` kept outside ``held_with``; frames that a caller cached stay."""
    _let_go(_global)


def in_threads(spark: SparkSession, fn: Callable, items: list, threads: int) -> list:
    """``fn`` of every item, several at a time; frames that it holds belong to the caller's result."""
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target

    context = copy_context()
    run = inheritable_thread_target(spark)(lambda item: context.copy().run(fn, item))
    with ThreadPool(max(1, min(threads, len(items)))) as pool:
        return pool.map(run, items, chunksize=1)


def slots(spark: SparkSession) -> int:
    """Tasks that a barrier stage may have at present; 1 if the session may lend its executors to others."""
    sc = spark.sparkContext
    if sc.getConf().get("spark.dynamicAllocation.enabled", "false") == "true":
        return 1
    return sc._jsc.sc().maxNumConcurrentTasks(sc._jsc.sc().resourceProfileManager().defaultResourceProfile())


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never a local checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
