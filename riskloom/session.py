"""Session settings and the one way this library cuts lineage: a table in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Category values become column names, and two values may differ only in case.
    "spark.sql.caseSensitive": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "riskloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only on a local master that names none."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    active = spark.sparkContext._jsc.sc().getCheckpointDir()
    if active.isDefined():
        return active.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="riskloom-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


_SCRATCH: list[str] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder for the tables that :func:`materialize` writes inside the block, removed at its end.

    For plans whose result is written elsewhere; a DataFrame that leaves the block must not read
    from inside it.
    """
    path = f"{shared_dir(spark)}/riskloom/run-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    try:
        yield path
    finally:
        _SCRATCH.remove(path)
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def together(spark: SparkSession, calls: Sequence[Callable]) -> list:
    """The results of independent calls, whose jobs run side by side: a training has few long tasks, one a model, and
    leaves most cores idle while it is alone."""
    with ThreadPoolExecutor(max(1, len(calls))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]
    return [r.result() for r in running]


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Downstream plans start from files, so a lost executor re-reads instead of recomputing. The
    file size is also a statistic the planner trusts: a join with a small fitted table becomes a
    broadcast join only when its size is below ``spark.sql.autoBroadcastJoinThreshold``, and a
    sort-merge join with run-time skew splitting otherwise.
    """
    spark = df.sparkSession
    folder = _SCRATCH[-1] if _SCRATCH else f"{shared_dir(spark)}/riskloom"
    path = f"{folder}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
