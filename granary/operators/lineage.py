"""Cutting the lineage of iterative plans.

``checkpoint()`` keeps the size estimate of the plan that it cuts: where each round joins a table with itself, the digits of that estimate grow by a factor a round, and planning ends in arithmetic on huge integers. A table written and read again has its real size, so joins are chosen by that.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session: the one set already, else that of spark.checkpoint.dir, else, on a local master only, a new temporary one."""
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isEmpty():
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        if not named and not spark.sparkContext.master.startswith("local"):
            raise ValueError("on a cluster, spark.checkpoint.dir must name a shared folder")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="granary-"))
    return jsc.getCheckpointDir().get()


def settled(df: DataFrame, *gone: DataFrame) -> DataFrame:
    """The rows of df from a table in the shared folder: a lost executor costs no recomputation, and estimates are real sizes. ``gone``: settled tables that only df needed; they are deleted. Spark deletes the shuffle files of the write once the driver's collector has found its plan, so that is asked for: on a long job they would fill the disks."""
    spark = df.sparkSession
    at = f"{shared_folder(spark)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(at)
    discard(*gone)
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(at)
    out.__dict__["settled_at"] = at
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes settled tables that nothing needs any longer."""
    for df in tables:
        if at := df.__dict__.pop("settled_at", None):
            jvm = df.sparkSession.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
