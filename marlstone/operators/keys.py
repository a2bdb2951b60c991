"""Surrogate keys and unknown members."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: Rows that one task may sort.
ONE_TASK = 1_000_000


def checkpoint_folder(spark: SparkSession) -> None:
    """Checkpoints go to spark.checkpoint.dir; where that is unset and everything runs on one machine, to a temporary folder."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        at = spark.conf.get("spark.checkpoint.dir", None)
        if not at and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(at or tempfile.mkdtemp(prefix="marlstone-"))


def surrogate_keys(new: DataFrame, order: list[str], name: str, start: int = 0, parallel: bool | None = None) -> DataFrame:
    """Numbers start + 1, start + 2, ... in the order of unique columns ``order``.

    Up to ``ONE_TASK`` rows are sorted in one task. Beyond that, or with ``parallel``, the rows are split by range, counted,
    and numbered with the counts before them as offsets; for this the result is checkpointed.
    """
    if parallel is None:
        parallel = new.limit(ONE_TASK + 1).count() > ONE_TASK
    if not parallel:
        return new.withColumn(name, (F.row_number().over(Window.orderBy(*order)) + start).cast("bigint"))
    parts = new.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    checkpoint_folder(new.sparkSession)
    parts = parts.checkpoint()  # a lost executor must not number rows anew
    counts = parts.groupBy("__part").count()
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("__part").alias("__p"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__part").orderBy(*order)
    out = parts.withColumn("__n", F.row_number().over(inside)).join(F.broadcast(offsets), F.col("__part") == F.col("__p"))
    return out.withColumn(name, (F.col("__n") + F.col("__before") + start).cast("bigint")).drop("__part", "__p", "__before", "__n")


def highest_key(dim: DataFrame, name: str) -> int:
    """The largest key in use; unknown members don't count."""
    return dim.filter(F.col(name) > 0).agg(F.coalesce(F.max(name), F.lit(0))).first()[0]


def ensure_member(dim: DataFrame, key: str, row: dict) -> DataFrame:
    """``dim`` with the literal member, unless its key is there already."""
    member = dim.sparkSession.createDataFrame([tuple(row.get(f.name) for f in dim.schema)], _nullable(dim.schema))
    return dim.unionByName(member.join(dim.select(F.col(key).alias("__k")), F.col(key) == F.col("__k"), "left_anti"))


def _nullable(schema):
    from pyspark.sql.types import StructField, StructType

    return StructType([StructField(f.name, f.dataType, True) for f in schema])
