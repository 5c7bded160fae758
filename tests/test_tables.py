"""What writing a table leaves on the local disks."""

import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from paperbrook.llm.common import written
from paperbrook.session import FREED
from paperbrook.sources.tables import write_bucketed, write_snapshot


def shuffle_files(spark):
    folders = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    return {f"{at}/{name}" for folder in folders for at, _, names in os.walk(folder) for name in names if name.startswith("shuffle_")}


@pytest.mark.parametrize("write", [
    lambda df: write_snapshot(df, tempfile.mkdtemp(prefix="run-") + "/table"),
    lambda df: write_bucketed(df, tempfile.mkdtemp(prefix="run-") + "/table", "k", 2),
    lambda df: written(df, "freed"),
])
def test_a_written_table_leaves_no_shuffle_files(spark, write):
    before = shuffle_files(spark)
    table = write(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):  # they go in the background
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert table.count() == 7
    assert spark.conf.get(next(iter(FREED))) == "false"
