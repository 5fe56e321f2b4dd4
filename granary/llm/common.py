"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators.lineage import settled, shared_folder

WS = r"[\x20\x09-\x0D]+"
BATCH_ROWS, BATCH_BYTES = 1000, 1 << 24
_shipped: set[str] = set()


def ready(spark: SparkSession) -> SparkSession:
    """Small Arrow batches (texts can be long), a checkpoint folder (the cluster's own where it names one), and the package for the executors."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")  # a finished action's shuffle files go
    shared_folder(spark)
    if spark.sparkContext.applicationId not in _shipped:  # executors need the package wherever the driver has it from
        _shipped.add(spark.sparkContext.applicationId)
        root, to = Path(__file__).resolve().parents[2], Path(tempfile.mkdtemp()) / "granary.zip"
        with zipfile.ZipFile(to, "w") as z:
            for f in sorted((root / "granary").rglob("*.py")):
                z.write(f, f.relative_to(root))
        spark.sparkContext.addPyFile(str(to))
    return spark


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished jobs; its cleaner acts on what the driver's garbage collectors have found."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def arrow_map(df: DataFrame, make: Callable[[], Callable[[dict[str, list]], dict[str, list]]], schema: str) -> DataFrame:
    """mapInArrow over columns as Python lists; ``make`` runs once a task and returns the function for each batch."""
    from pyspark.sql.types import StructType, _parse_datatype_string

    kind: StructType = _parse_datatype_string(schema)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        out, f = to_arrow_schema(kind), make()
        for b in batches:
            got = f({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)})
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f_.type) for x, f_ in zip((got[f_.name] for f_ in out), out)], schema=out)

    return df.mapInArrow(run, kind)


def ws_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``; null gives none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WS, -1), "")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is. Where all is ASCII, that is what lower() does, in much less time."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def apart(small: DataFrame, key: str) -> DataFrame:
    """The small side of a join on a long key, so written that Spark does not see that it is dealt by the key already: it then deals out both sides for the join, and can split the rows of a hot key on the other side."""
    return small.withColumn(key, F.col(key).bitwiseXOR(F.lit(0).cast("long")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component = least reachable node) of the edges (a, b). Alternating large-star and small-star steps up to their fixed point, where every edge leads to the least node of its component; every round is written and read again, so that lost executors cost one round and estimates stay real sizes. Groups are only reduced by min, never collected; the minima go through an exchange of their own, so that the joins can split the rows of a hub."""
    both = lambda e: e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = lambda e, own: apart(e.groupBy("a").agg((F.least(F.min("b"), F.col("a")) if own else F.min("b")).alias("m")), "a")
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = settled(e)
    seen, now = None, (0,)
    while now != seen:
        seen, n = now, both(e)
        large = n.where("b > a").join(least(n, True), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        small = large.join(least(large, False), "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("s")).select("s.*").where("a <> b").distinct()
        e = settled(small, e)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())
    return e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionAll(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
