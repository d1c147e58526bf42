"""Tables written between the steps of an operator."""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def saved(df: DataFrame, free: bool = False) -> DataFrame:
    """A table written below the shared folder that ``spark.checkpoint.dir``
    names, and read again: it cuts the lineage like a checkpoint, but computes
    the table once. With ``free``, shuffle files of the steps before it go, and
    so do their plans and broadcasts on the driver, whose heap shrinks again."""
    from vigil.session import ensure_checkpoint_dir  # here, so that modules that hold this function travel by value

    spark, schema = df.sparkSession, df.schema
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    del df
    if free:
        release(spark)
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of steps that are written out: its
    cleaner acts when the driver has collected the plans that held them. The
    scheduler holds on to the last job's plan until another has run, so a
    trivial job goes first."""
    spark.range(1).count()
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(0.2)
