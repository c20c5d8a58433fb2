"""Tables between steps: written once to the folder that driver and executors share, and read again.

What several later steps need is then computed once, the plan behind it is short, and a lost executor costs a reread.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; only a ``local`` master without the setting, as in tests, gets a folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError(f"spark.checkpoint.dir isn't set; {spark.sparkContext.master} needs a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="riskloom-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table; its files go when the session ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/riskloom-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def unstaged(df: DataFrame) -> None:
    """Delete the files behind a staged frame that nothing reads any more."""
    spark = df.sparkSession
    for name in {os.path.dirname(x) for x in df.inputFiles()}:
        at = spark._jvm.org.apache.hadoop.fs.Path(name)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
