"""Session helpers and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import re
import tempfile
import time
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "tradeweave", **extra: str) -> SparkSession:
    """Session with adaptive execution; a cluster's own settings win where given."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULTS, **extra}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where driver and executors are one machine, as in tests, an unset folder is made up.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir (or --scratch) to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="tradeweave-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


class Scratch:
    """Tables written under one fresh folder of the shared root.

    Writing a table and reading it back replaces a long lineage by a file scan that every executor
    can repeat, so a lost executor costs only its own tasks.
    """

    def __init__(self, spark: SparkSession, label: str = "run"):
        self.spark = spark
        self.path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = self.at(name)
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def forget(self, *names: str) -> None:
        """Delete tables that nothing refers to any more."""
        for name in names:
            remove_path(self.spark, self.at(name))

    def drop(self) -> None:
        """Delete this folder once nothing lazy refers to it any more."""
        remove_path(self.spark, self.path)


def import_in_workers(spark: SparkSession) -> None:
    """Let Python workers import this package where it lies at the same path as here; elsewhere it is shipped as usual."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[1])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def remove_path(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.delete(p, True))


def move_path(spark: SparkSession, source: str, target: str) -> None:
    p, fs = _fs(spark, source)
    if not fs.rename(p, _fs(spark, target)[0]):
        raise OSError(f"cannot move {source} to {target}")


def mark_done(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, f"{path}/_SUCCESS")
    fs.create(p, True).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _fs(spark, path)
    out = fs.create(p, False)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def age_hours(spark: SparkSession, path: str) -> float:
    """Hours since a file or folder was last changed."""
    p, fs = _fs(spark, path)
    return (time.time() * 1000 - fs.getFileStatus(p).getModificationTime()) / 3_600_000


def child_names(spark: SparkSession, path: str) -> list[str]:
    p, fs = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
