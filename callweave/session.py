"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are planned for; a cluster may override any of them.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def builder(app: str = "callweave"):
    b = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor shares, as named by ``spark.checkpoint.dir``.

    Only where neither that setting nor a checkpoint directory exists, and only in local
    mode, a folder of our own is made.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="callweave-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's interface for a path of any store."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, folder = hadoop_path(spark, path)
    return fs.exists(folder)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, folder = hadoop_path(spark, path)
    fs.delete(folder, True)


class StageRun:
    """The stages of one run, in a folder of their own that a restarted driver finds again."""

    def __init__(self, spark: SparkSession, run_id: str):
        self.spark, self.path, self.made = spark, f"{scratch_root(spark)}/run-{run_id}", 0

    def next_path(self, name: str) -> str:
        self.made += 1
        return f"{self.path}/{self.made:04d}-{name}"


_run: ContextVar[StageRun | None] = ContextVar("stage run", default=None)


@contextmanager
def stage_run(spark: SparkSession, run_id: str | None = None) -> Iterator[StageRun]:
    """Register all stages that are written inside the block under one run.

    When the block ends, the run's folder is deleted: read or write the results inside. When it
    fails, the folder stays, and a later block with the same ``run_id`` and the same steps takes
    the stages that were finished and goes on from there. A block inside another one belongs to
    the outer run.
    """
    if _run.get() is not None:
        yield _run.get()
        return
    run = StageRun(spark, run_id or uuid.uuid4().hex)
    token = _run.set(run)
    try:
        yield run
    finally:
        _run.reset(token)
    delete_path(spark, run.path)


# Spark deletes the shuffle files of a query when it ends, and not when the driver happens to
# collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside the block leave no shuffle files: what they give is written, so
    nothing reads these files again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a stage feeds several later stages: the lineage is cut at a table that
    outlives any executor, and later scans prune columns and push filters. Inside a
    ``stage_run`` a stage that an earlier attempt finished is read and not made again; one that
    it had released is made only if it is read after all.
    """
    spark, run = df.sparkSession, _run.get()
    path = run.next_path(name) if run else scratch_path(spark, name)
    if run and path_exists(spark, f"{path}.released"):
        return df
    if not (run and path_exists(spark, f"{path}/_SUCCESS")):
        with shuffles_go(spark):
            df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stage_path = path
    return out


def release(*stages: DataFrame) -> None:
    """Delete stages whose last reader has been written; other tables are left alone."""
    for stage in stages:
        path = getattr(stage, "stage_path", None)
        if path:
            if _run.get() is not None:
                fs, folder = hadoop_path(stage.sparkSession, f"{path}.released")
                fs.create(folder).close()
            delete_path(stage.sparkSession, path)
