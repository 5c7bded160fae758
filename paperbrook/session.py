"""Session defaults and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Texts vary from bytes to megabytes: bound Arrow batches by size, not only by row count.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
}


def build_session(master: str | None = None, app: str = "paperbrook", **conf: str) -> SparkSession:
    """A session with the defaults above; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Shuffle files of a finished write go at once; else they stay until the driver's JVM happens to collect its garbage, and
# the files of all steps of a long query lie on disk together.
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, names: dict[str, str]) -> Iterator[None]:
    """Settings of the session for as long as the block lasts."""
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = "/tmp/paperbrook-shared"
    return folder.rstrip("/")


def new_run_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; never reused, so a retry cannot mix with older output."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
