"""Small helpers on DataFrames shared by the corpus operators."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOWEST = -(1 << 63)
MAX_BATCH_ROWS = 1000
MAX_BATCH_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted column names, each lengthened until the table has no such column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        out.append(name)
    return out


def column(df: DataFrame, name: str) -> Column:
    return df[f"`{name}`"]


def row_key(df: DataFrame, doc_id: str, text: str) -> dict[str, Column]:
    """One or two longs, never null, equal only for rows that agree in id and text.

    k1 stands for the id; k2, a hash of the text, is there only if some id stands
    twice (one slim count over the ids), as it costs 8 bytes in every shuffled row.
    """
    key = column(df, doc_id)
    if isinstance(df.schema[doc_id].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        first = F.coalesce(key.cast("bigint"), F.lit(LOWEST))
    else:
        first = F.xxhash64(key.cast("string"))
    repeated = df.select(first.alias("k")).groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    if repeated.isEmpty():
        return {"k1": first}
    return {"k1": first, "k2": F.xxhash64(key.isNull(), column(df, text).isNull(), column(df, text))}


def texts_in_small_batches(spark: SparkSession) -> None:
    """At most MAX_BATCH_ROWS rows and, but for one longer text, MAX_BATCH_BYTES an Arrow batch: rows that
    hold whole texts are large.  Spark reads both settings when a plan runs, so they stay set in this session;
    smaller ones of the caller's hold."""
    for name, most in (("maxRecordsPerBatch", MAX_BATCH_ROWS), ("maxBytesPerBatch", MAX_BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        given = re.fullmatch(r"(\d+)b?", spark.conf.get(name), re.I)       # other units: more than enough, or none
        if not given or not 0 < int(given[1]) <= most:
            spark.conf.set(name, str(most))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: what the session names in ``spark.checkpoint.dir``.

    Where none is named, one process on one machine gets a temporary folder; a
    cluster never does.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="storelens-checkpoint-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and go on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
