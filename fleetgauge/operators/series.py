"""Sums over a trailing range of time, for series of which one may hold any share of the rows.

Whole numbers are added up along one order over all series, by key and time, so that what lies between two places of a
key is the difference of two sums: a row costs the same however many its range covers. The order is cut into ranges
of about equally many rows, whichever keys they belong to, and the sums before each range are one row per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.session import shared_dir

_WHOLE = "decimal(38,0)"
_ID_BITS = 33  # of a row's place in its partition, in monotonically_increasing_id


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` in a table, cut by ``order`` into parts ``_part`` of about equally many rows, with their place ``_id`` there.
    Rows should differ in ``order``. Parts and places are numbered along the order."""
    spark, location = rows.sparkSession, shared_dir(rows.sparkSession, "placed")
    numbered = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    numbered.write.parquet(location)
    return spark.read.schema(numbered.schema).parquet(location).withColumn("_part", F.shiftright("_id", _ID_BITS))


def running_sums(rows: DataFrame, order: list[str], sums: list[str]) -> DataFrame:
    """``rows`` with the columns ``sums`` replaced by their sums over all rows up to each one in ``order``, in which
    rows differ."""
    table = placed(rows, order)
    parts = table.groupBy("_part").agg(*[F.sum(c).alias(c) for c in sums]).collect()
    before, held = [], [0] * len(sums)
    for row in sorted(parts, key=lambda r: r["_part"]):
        before.append((row["_part"], *[str(x) for x in held]))
        held = [x + (row[c] or 0) for x, c in zip(held, sums, strict=True)]
    schema = ", ".join(["_part bigint", *[f"_before_{c} string" for c in sums]])
    carried = rows.sparkSession.createDataFrame(before, schema)
    so_far = Window.partitionBy("_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)
    kinds = {c: rows.schema[c].dataType for c in sums}
    total = {c: (F.coalesce(F.sum(c).over(so_far), F.lit(0)) + F.col(f"_before_{c}").cast(kinds[c])).cast(kinds[c]) for c in sums}
    others = [c for c in rows.columns if c not in sums]
    return table.join(carried, "_part").select(*others, *[total[c].alias(c) for c in sums])


def with_previous(rows: DataFrame, series: tuple[str, ...], at: str, value: str) -> DataFrame:
    """``rows`` with ``previous``, the value of the series' row before; a series has one row per ``at``."""
    table = placed(rows, [*series, at])
    ends = table.groupBy("_part").agg(F.max_by(F.struct(*series, value), "_id").alias("end")).collect()
    ends = sorted((r["_part"], r["end"]) for r in ends)
    schema = T.StructType([
        T.StructField("_part", T.LongType()),
        *[T.StructField(f"_last_{c}", rows.schema[c].dataType) for c in (*series, value)],
    ])
    pairs = zip(ends, ends[1:], strict=False)
    carried = rows.sparkSession.createDataFrame([(part, *end) for (_, end), (part, _) in pairs], schema)
    inside = Window.partitionBy("_part", *series).orderBy("_id")
    first = F.row_number().over(inside) == 1
    same = F.lit(True)
    for c in series:
        same = same & F.col(c).eqNullSafe(F.col(f"_last_{c}"))
    joined = table.join(carried, "_part", "left")
    # Only the part's first series goes on from the part before; that part's last row is of the series before it else.
    before = F.when(first & same, F.col(f"_last_{value}")).otherwise(F.lag(value).over(inside))
    return joined.select(*rows.columns, before.alias("previous"))


def runs(rows: DataFrame, series: tuple[str, ...], at: str, active: str) -> DataFrame:
    """``rows`` with ``since``: where the run of active rows began that a row belongs to, null for one that isn't active.

    What a part says of the run that leaves it is one row: its last series, whether that series covers the part without a
    break, and where its last run began. Such rows combine from part to part into the run each part is entered with.
    """
    table = placed(rows, [*series, at])
    inside = Window.partitionBy("_part", *series).orderBy("_id")
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    on = F.coalesce(F.col(active), F.lit(False))
    starts = F.when(on & ~F.coalesce(F.lag(on).over(inside), F.lit(False)), F.col(at))
    followed = table.withColumns({"_start": starts, "_breaks": F.count(F.when(~on, 1)).over(so_far)})
    followed = followed.withColumn("_began", F.when(on, F.last("_start", ignorenulls=True).over(so_far)))
    ends = followed.groupBy("_part").agg(
        F.min_by(F.struct(*series), "_id").alias("first"),
        F.max_by(F.struct(*series), "_id").alias("last"),
        F.max_by(F.struct("_breaks", "_began"), "_id").alias("end"),
    ).collect()
    entered, held, of = [], None, None
    for r in sorted(ends, key=lambda r: r["_part"]):
        entered.append((r["_part"], *(of or [None] * len(series)), held))
        unbroken = r["first"] == r["last"] and r["end"]["_breaks"] == 0
        if not (unbroken and of == tuple(r["last"]) and held is not None):
            held = r["end"]["_began"]
        of = tuple(r["last"])
    schema = T.StructType([
        T.StructField("_part", T.LongType()),
        *[T.StructField(f"_last_{c}", rows.schema[c].dataType) for c in series],
        T.StructField("_entered", rows.schema[at].dataType),
    ])
    carried = rows.sparkSession.createDataFrame(entered, schema)
    same = F.lit(True)
    for c in series:
        same = same & F.col(c).eqNullSafe(F.col(f"_last_{c}"))
    whole = on & (F.col("_breaks") == 0) & same
    since = F.when(whole, F.coalesce("_entered", "_began")).otherwise(F.col("_began"))
    return followed.join(carried, "_part", "left").select(*rows.columns, since.alias("since"))


def trailing_sums(
    rows: DataFrame, keys: tuple[str, ...], at: Column, window: int, kind: str = _WHOLE, **values: Column
) -> DataFrame:
    """``(keys, at)`` of every instant of a key that has rows, and for each of ``values`` its sum over the key's rows from
    ``window`` before to that instant, both included. ``at`` and ``window`` are whole numbers of one unit; sums are exact decimals of the given ``kind``."""
    names = list(values)
    instants = rows.select(*keys, at.alias("at"), *[v.cast(kind).alias(n) for n, v in values.items()])
    # Rows of one instant become one before anything is ordered.
    instants = instants.groupBy(*keys, "at").agg(*[F.sum(n).cast(kind).alias(n) for n in names])
    zero = [F.lit(0).cast(kind).alias(n) for n in names]
    # A look-up stands where its range begins, before a row of the same instant.
    looking = instants.select(*keys, (F.col("at") - window).alias("at"), F.lit(0).alias("_kind"), *zero)
    points = instants.select(*keys, "at", F.lit(1).alias("_kind"), *names)
    summed = running_sums(looking.unionByName(points), [*keys, "at", "_kind"], names)
    begun = summed.where("_kind = 0").select(*keys, (F.col("at") + window).alias("at"), *[F.col(n).alias(f"_{n}") for n in names])
    ended = summed.where("_kind = 1")
    return ended.join(begun, [*keys, "at"]).select(*keys, "at", *[(F.col(n) - F.col(f"_{n}")).cast(kind).alias(n) for n in names])
