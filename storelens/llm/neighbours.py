"""The next row in the order of an id, without sorting a whole table in one task.

Rows are cut by (id, tie) into ranges of about equal numbers; each range is one window
partition, and it also gets a copy of the row that starts the following range
(the last range gets the table's first row).  So every row is shuffled once and
finds its successor in its own range, and one id in many rows is spread over ranges.

Rows equal in id and tie can't be cut apart.  Where they are more than a few ranges'
worth, one of them stands for all in the window; the next row of every other is its equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGES_PER_PARTITION = 4
MAX_RANGES = 20_000                  # their starts are one literal of the plan


HOT_ROWS = 10_000                    # fewer equal rows are never taken out of a range
COPIES = 1_000                       # equal rows that one row is multiplied to at a time


def _range_starts(places: DataFrame, count: int) -> list:
    """Smallest place of each of about ``count`` ranges: that many values reach the driver."""
    dealt = places.repartitionByRange(count, "place").groupBy(F.spark_partition_id().alias("p")).agg(
        F.min("place").alias("place"))
    return sorted((r.place for r in dealt.collect()), key=lambda x: (x.set, x.id if x.set else 0, x.tie))


def _range_of(place: Column, starts: list, kind: str) -> Column:
    """How many of the starts lie at or below the place, by binary search."""
    if not starts:
        return F.lit(0)
    bound = F.array(*[F.struct(F.lit(s.set).alias("set"), F.lit(s.id).cast(kind).alias("id"), F.lit(s.tie).alias("tie"))
                      for s in starts])
    steps = [1 << i for i in reversed(range(len(starts).bit_length()))]
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(
        (at + step <= len(starts)) & (F.get(bound, at + step - 1) <= place), at + step).otherwise(at))


def _hot_rows(ranged: DataFrame, key: str, tie: str, firsts: list) -> list:
    """(id, tie, n) of equal rows that are more than some four ranges should hold: at most a
    quarter as many as there are ranges."""
    limit = max(HOT_ROWS, 4 * sum(r.n for r in firsts) // len(firsts))
    full = [r[0] for r in firsts if r.n > limit]
    if not full:
        return []
    return ranged.where(F.col("__range").isin(full)).groupBy(F.col(key).alias("id"), F.col(tie).alias("tie")).agg(
        F.count("*").alias("n")).where(F.col("n") > limit).collect()


def with_next(df: DataFrame, key: str, tie: str, take: dict[str, str]) -> DataFrame:
    """Add the columns ``take`` = {new name: column of the next row}, by ascending
    ``key`` (null first), then ``tie`` (a long); the last row's next is the first.

    Rows that agree in key and tie are taken for equal in all columns.
    """
    spark = df.sparkSession
    count = min(MAX_RANGES, int(spark.conf.get("spark.sql.shuffle.partitions")) * RANGES_PER_PARTITION)
    kind = df.schema[key].dataType.simpleString()
    place = F.struct(F.col(key).isNotNull().alias("set"), F.col(key).alias("id"), F.col(tie).alias("tie"))
    starts = _range_starts(df.select(place.alias("place")), count)
    ranged = df.withColumn("__range", _range_of(place, starts, kind))
    # one row a range: at most ``count`` rows, whatever the table's size
    firsts = sorted(ranged.groupBy("__range").agg(F.min(place).alias("first"), F.count("*").alias("n")).collect(),
                    key=lambda r: r[0])
    if not firsts:
        return ranged.drop("__range").withColumns({new: F.col(old) for new, old in take.items()})
    goes = {firsts[i].asDict()["__range"]: firsts[i - 1].asDict()["__range"] for i in range(len(firsts))}
    copies = None
    if hot := _hot_rows(ranged, key, tie, firsts):
        same = F.broadcast(spark.createDataFrame([tuple(r) for r in hot], f"__hid {kind}, __htie bigint, __n bigint"))
        equal = F.col(key).eqNullSafe(F.col("__hid")) & (F.col(tie) == F.col("__htie"))
        one = ranged.join(same, equal).groupBy("__hid", "__htie", "__n").agg(
            F.first(F.struct(*ranged.columns)).alias("row")).select("row.*", "__n")
        ranged = ranged.join(same, equal, "left_anti").unionByName(one.drop("__n"))
        # dealt out in parts, so no task makes them all
        parts = one.withColumn("__part", F.explode(F.expr(f"sequence(0, (__n - 2) div {COPIES})"))).repartition(
            count, key, tie, "__part")
        copies = parts.withColumn("__copy", F.explode(F.expr(
            f"sequence(1, least({COPIES}, __n - 1 - __part * {COPIES}))"))).select(
            *df.columns, *[F.col(old).alias(new) for new, old in take.items()])
    small = spark.createDataFrame(
        [(r[0], r[1].id, r[1].tie, goes[r[0]]) for r in firsts],
        f"__r int, __id {kind}, __tie bigint, __goes int")
    starting = ranged.join(F.broadcast(small), (F.col("__range") == F.col("__r"))
                           & F.col(key).eqNullSafe(F.col("__id")) & (F.col(tie) == F.col("__tie")), "left")
    # a range's first row stands twice: in its own range and, as a guest, behind the range before
    seated = starting.withColumn("__seat", F.explode(F.when(F.col("__goes").isNull(), F.array(
        F.struct(F.col("__range").alias("r"), F.lit(0).alias("guest")))).otherwise(F.array(
            F.struct(F.col("__range").alias("r"), F.lit(0).alias("guest")),
            F.struct(F.col("__goes").alias("r"), F.lit(1).alias("guest"))))))
    order = Window.partitionBy("__seat.r").orderBy("__seat.guest", F.col(key).asc_nulls_first(), tie)
    out = seated.select(*df.columns, "__seat", *[F.lead(old).over(order).alias(new) for new, old in take.items()])
    out = out.where("__seat.guest = 0").drop("__seat")
    return out if copies is None else out.unionByName(copies)
