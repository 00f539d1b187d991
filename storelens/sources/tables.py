"""Lazy access to the raw parquet tables of one data directory.

Each table is a plain ``spark.read.parquet`` DataFrame, so Catalyst prunes
columns and pushes filters into the scan for whatever a plan references.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cached_property

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

FILES_A_TASK = 200                   # footers one task reads

# The raw table schemas (FIXTURES.md section 1).  Reading with a
# declared schema skips the footer-inference job Spark otherwise runs for every
# read.  Parquet fills a column that a file lacks with NULL, so the names in every
# file's footer are compared first.
RAW_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}
RAW_TABLES = tuple(RAW_SCHEMAS)


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The files Spark would read at ``path``; none where nothing is there."""
    try:
        return spark.read.schema("any_column int").parquet(path).inputFiles()
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def _names(file: str) -> set[str] | None:
    """Column names in a Parquet footer; None: a file system that pyarrow doesn't know."""
    try:
        system, at = FileSystem.from_uri(file)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
        return None
    return set(pq.read_schema(at, filesystem=system).names)


def lacking_file(spark: SparkSession, path: str, wanted: Sequence[str]) -> tuple[str, list[str]] | None:
    """A file at ``path`` without some of the wanted columns, and which; None: every file has all.

    Footers are read in tasks, FILES_A_TASK each, but for a table of one file.  Where pyarrow can't
    open the file system, Spark's own schema of the path is compared instead.
    """
    files = data_files(spark, path)

    def lacks(file: str) -> list[str] | None:
        names = _names(file)
        return None if names is None else [c for c in wanted if c not in names]

    if not files:
        return None
    first = lacks(files[0])
    if first is None:
        there = spark.read.option("mergeSchema", "true").parquet(path).columns
        missing = [c for c in wanted if c not in there]
        return (path, missing) if missing else None
    if first or len(files) == 1:
        return (files[0], first) if first else None

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(f, ", ".join(m)) for f in batch.column(0).to_pylist() if (m := lacks(f))]
            yield pa.RecordBatch.from_pylist([{"file": f, "missing": m} for f, m in found], schema=pa.schema(
                [("file", pa.string()), ("missing", pa.string())]))

    tasks = -(-len(files) // FILES_A_TASK)
    listed = spark.createDataFrame(pa.table({"file": files})).repartition(tasks)
    bad = listed.mapInArrow(check, "file string, missing string").first()
    return (bad.file, bad.missing.split(", ")) if bad else None


class Tables:
    """Raw tables of a data directory, read on first access.

    ``infer_schema=True`` reads each table's own footer schema instead of the
    declared one (for inputs with other column types).
    """

    def __init__(self, spark: SparkSession, root: str, infer_schema: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        self.infer_schema = infer_schema

    def read(self, name: str) -> DataFrame:
        path = f"{self.root}/{name}.parquet"
        reader = self.spark.read
        if not self.infer_schema and name in RAW_SCHEMAS:
            bad = lacking_file(self.spark, path, [c.split()[0] for c in RAW_SCHEMAS[name].split(", ")])
            if bad:
                raise ValueError(f"{bad[0]} has no column {', '.join(bad[1])}")
            reader = reader.schema(RAW_SCHEMAS[name])
        return reader.parquet(path)

    @cached_property
    def nation(self) -> DataFrame:
        return self.read("nation")

    @cached_property
    def customer(self) -> DataFrame:
        return self.read("customer")

    @cached_property
    def part(self) -> DataFrame:
        return self.read("part")

    @cached_property
    def orders(self) -> DataFrame:
        return self.read("orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.read("lineitem")
