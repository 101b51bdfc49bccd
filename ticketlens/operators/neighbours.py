"""Mutual information of numbers and classes by nearest neighbours in one dimension.

For a value, the distance to its k-th nearest neighbour within its class is a
radius; the fewer values of other classes lie within it, the more the value says
about the class. With digamma for the logarithm of counts the estimate is

    digamma(N) + mean digamma(k) - mean digamma(class size) - mean digamma(values within the radius).

Equal values are no neighbours at a distance: where at least k others of the class
are equal, the equal ones of the class and of all classes are counted in place of
k and the values within the radius. For a flag that is its contingency table. So
the result needs no random noise to part ties and always repeats. Values of a
class with a single one are left out.

Everything works on distinct values with their counts. They are cut into ordered
ranges, so a column of any length is spread over tasks: neighbours are the k rows
before and after within a range; only the first and last k of a class in a range
look beyond it, in a small table of such rows. How many values lie below a point
is a running sum within a range plus the sum of all ranges before.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ticketlens.session import materialize

NEIGHBOURS = 3
# values with a place of their own that one range holds
RANGE_ROWS = 250_000
# values within this share of the radius count as nearer, so that rounding takes none at the radius in
INSIDE = 1.0 - 1e-9


def digamma(n: Column) -> Column:
    """Digamma of a whole number from 1 on: the asymptotic series ten places on, and back by its recurrence."""
    m = n.cast("double") + 10.0
    far = F.log(m) - 0.5 / m - 1.0 / (12.0 * m**2) + 1.0 / (120.0 * m**4) - 1.0 / (252.0 * m**6)
    return far - functools.reduce(add, [1.0 / (n.cast("double") + float(j)) for j in range(10)])


def ranges(rows: DataFrame, order: list[str], size: int, range_rows: int) -> DataFrame:
    """The rows in ordered ranges, numbered by `chunk`; written once, as bounds are sampled."""
    parts = max(1, -(-size // range_rows))
    cut = rows.repartitionByRange(parts, *order) if parts > 1 else rows.coalesce(1)
    return materialize(cut.withColumn("chunk", F.spark_partition_id()))


def _near(group: WindowSpec, k: int) -> list[Column]:
    """The k next values of the class on either side with their counts: x-1, n-1, x+1, n+1, x-2 and so on."""
    return [of(c, j).over(group.orderBy("x")).alias(f"{c}{sign}{j}") for j in range(1, k + 1) for of, sign in ((F.lag, "-"), (F.lead, "+")) for c in ("x", "n")]


def _radius(rows: DataFrame, k: int) -> DataFrame:
    """Adds k (of the class), radius, and low and high, the interval of the values within it, from the next values beside the rows."""
    def side(sign: str) -> list[tuple[Column, Column]]:
        away = [(F.lit(0.0), F.lit(0).cast("long"))]
        for j in range(1, k + 1):
            distance = F.col("x") - F.col(f"x-{j}") if sign == "-" else F.col(f"x+{j}") - F.col("x")
            away.append((distance, away[-1][1] + F.col(f"n{sign}{j}")))
        return away

    wanted = F.least(F.lit(k).cast("long"), F.col("size") - 1)
    need = rows.select("*", wanted.alias("k"), (wanted - (F.col("n") - 1)).alias("need"))
    # the least distance that reaches enough values, so many below and so many above; none are needed at a distance of 0
    reached = [
        F.when(below + above >= F.col("need"), F.greatest(down, up)) for down, below in side("-") for up, above in side("+")
    ]
    ruled = need.withColumn("radius", F.least(*reached))
    reach = F.col("radius") * F.lit(INSIDE)
    kept = [c for c in rows.columns if c not in [f"{c}{s}{j}" for c in "xn" for s in "-+" for j in range(1, k + 1)]]
    return ruled.select(*kept, "k", "radius", (F.col("x") - reach).alias("low"), (F.col("x") + reach).alias("high"))


def _ruled(sized: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """The rows (i, label, x, n, size, chunk) with k, radius, low and high: those whose neighbours all lie in their range, and the
    others, the first and last of a class in its range.

    The interval of the former lies within the range too: what lies beyond it is further than the k values on that side.
    """
    local = Window.partitionBy("chunk", "i", "label")
    # one shuffle by range; the neighbours of the first and last k are among the first and last 2 k
    rows = sized.repartition("chunk").select("*", *_near(local, k), *[
        of("x", 2 * k).over(local.orderBy("x")).isNull().alias(name) for of, name in ((F.lag, "at_start"), (F.lead, "at_end"))])
    inner = F.col(f"x-{k}").isNotNull() & F.col(f"x+{k}").isNotNull()
    held = materialize(_radius(rows.withColumn("inner", inner).withColumn("edge", F.col("at_start") | F.col("at_end")).drop("at_start", "at_end"), k))
    edges = held.filter("edge").select("i", "label", "x", "n", "size", "chunk", "inner")
    around = edges.select("*", *_near(Window.partitionBy("i", "label"), k)).filter("NOT inner")
    return held.drop("edge"), _radius(around, k).drop("inner")


def _placed(sized: DataFrame, outer: DataFrame) -> DataFrame:
    """(chunk, i, at, place, base, and the row) of both ends of the intervals of `outer`: the range an end falls into and the number of values before that range."""
    sums = sized.groupBy("i", "chunk").agg(F.min("x").alias("at"), F.sum("n").alias("sum"))
    chain = Window.partitionBy("i").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("i", "at", F.lit(0).alias("place"), "chunk", F.coalesce(F.sum("sum").over(chain), F.lit(0)).alias("base"), F.lit(None).cast(ROW).alias("row"))
    points = outer.select("i", F.inline(F.array(
        F.struct(F.col("low").alias("at"), F.lit(0).alias("place")), F.struct(F.col("high").alias("at"), F.lit(2).alias("place")))),
        F.lit(None).cast("int").alias("chunk"), F.lit(None).cast("long").alias("base"), _row().alias("row"))
    # a range that starts at an end comes before it
    order = Window.partitionBy("i").orderBy("at", F.col("row").isNotNull())
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = starts.unionByName(points).select(
        "i", "at", "place", "row", F.last("chunk", ignorenulls=True).over(upto).alias("chunk"), F.last("base", ignorenulls=True).over(upto).alias("base"),
        F.min("chunk").over(Window.partitionBy("i")).alias("lowest"))
    return found.filter("row IS NOT NULL").select(F.coalesce("chunk", "lowest").alias("chunk"), "i", "at", "place", F.coalesce("base", F.lit(0)).alias("base"), "row")


ROW = "struct<label:string,x:double,n:bigint,size:bigint,k:bigint>"


def _row() -> Column:
    """The row an interval belongs to. Equal values are counted in place of k where there are enough of them."""
    counted = F.when(F.col("radius") > 0, F.col("k")).otherwise(F.col("n"))
    return F.struct("label", "x", "n", "size", counted).cast(ROW)


def _within(held: DataFrame, outer: DataFrame, sized: DataFrame) -> DataFrame:
    """(i, n, gain): rows and the sum of their shares in the information, a row per column and the rest of its rows.

    Values and ends of intervals are put in order range by range. An interval in one range needs no more than the
    running sum there; ends in several ranges are told from the start of the column.
    """
    none = F.lit(None).cast(ROW)
    zero = F.lit(0).cast("long")

    def event(at: Column, place: int, count: Column, row: Column) -> Column:
        return F.struct(at, F.lit(place), count, row).cast(f"struct<at:double,place:int,count:bigint,row:{ROW}>")

    value = event(F.col("x"), 1, F.col("n"), none)
    ends = [event(F.col("low"), 0, zero, _row()), event(F.col("high"), 2, zero, _row())]
    inner = held.select("chunk", "i", F.inline_outer(F.when(F.col("inner"), F.array(value, *ends)).otherwise(F.array(value)))).withColumn("base", zero)
    outer = _placed(sized, outer).withColumn("count", zero)
    # one shuffle by range serves the running sum and the meeting of the ends
    events = inner.unionByName(outer).repartition("chunk")
    run = Window.partitionBy("chunk", "i").orderBy("at", "place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    below = events.withColumn("below", F.sum("count").over(run) + F.col("base")).filter("row IS NOT NULL")
    sign = F.when(F.col("place") == 0, -F.col("below")).otherwise(F.col("below"))
    r = [F.col("row")[c].alias(c) for c in ("label", "x", "n", "size", "k")]
    met = below.select("chunk", "i", "place", *r, sign.alias("m")).groupBy("chunk", "i", "label", "x").agg(
        F.sum("m").alias("m"), F.count(F.lit(1)).alias("ends"), *[F.max(c).alias(c) for c in ("n", "size", "k")])
    whole = F.col("ends") == 2
    gain = F.col("n") * (digamma(F.col("k")) - digamma(F.col("size")) - digamma(F.col("m")))
    # rows with both ends in a range are summed at once, the few others meet by their value
    summed = met.groupBy("i", F.when(~whole, F.col("label")).alias("label"), F.when(~whole, F.col("x")).alias("x")).agg(
        F.sum(F.when(whole, F.col("n"))).alias("rows"), F.sum(F.when(whole, gain)).alias("gain"), F.sum("m").alias("m"), *[F.max(c).alias(c) for c in ("n", "size", "k")])
    one = F.col("rows").isNull()
    return summed.select("i", F.when(one, F.col("n")).otherwise(F.col("rows")).alias("n"), F.when(one, gain).otherwise(F.col("gain")).alias("gain"))


def neighbour_information(table: DataFrame, k: int = NEIGHBOURS, range_rows: int = RANGE_ROWS) -> dict[int, float]:
    """Mutual information (nats) per column i of a table (i, label, x, n): n rows of class `label` have the value x; 0 at least.

    Rows with equal i, label and x are added up.
    """
    counts = materialize(
        table.filter("n > 0 AND x IS NOT NULL AND NOT isnan(x)").groupBy("i", "label", F.col("x").cast("double").alias("x")).agg(F.sum("n").cast("long").alias("n"))
    )
    per_class = counts.groupBy("i", "label").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("values")).collect()  # columns x classes
    kept = [(r["i"], r["label"], r["size"]) for r in per_class if r["size"] > 1]
    out = {r["i"]: 0.0 for r in per_class}
    if not kept:
        return out
    sizes = F.broadcast(table.sparkSession.createDataFrame(kept, "i int, label string, size long"))
    size = sum(r["values"] for r in per_class)
    sized = ranges(counts.join(sizes, ["i", "label"]), ["i", "x"], size, range_rows)
    held, outer = _ruled(sized, k)
    for r in _within(held, outer, sized).groupBy("i").agg(F.sum("n").alias("n"), F.sum("gain").alias("gain")).select(
        "i", (digamma(F.col("n")) + F.col("gain") / F.col("n")).alias("mi")
    ).collect():
        out[r["i"]] = max(0.0, r["mi"])
    return out


def value_table(rows: DataFrame, columns: dict[int, Column], label: Column) -> DataFrame:
    """(i, label, x, n) of numeric columns, counted before the shuffle; rows without a label count nowhere."""
    none = F.array().cast("array<struct<i:int,x:double>>")
    cells = F.array(*[F.struct(F.lit(i).alias("i"), c.cast("double").alias("x")) for i, c in columns.items()]) if columns else none
    return rows.select(label.cast("string").alias("label"), F.inline(cells)).filter("label IS NOT NULL").groupBy("i", "label", "x").agg(F.count(F.lit(1)).alias("n"))


def binned_information(table: DataFrame, bins: int, whole: Sequence[int] = (), range_rows: int = RANGE_ROWS) -> dict[int, float]:
    """Mutual information over equal-frequency bins of each column of a table (i, label, x, n); `whole` columns keep their values as bins.

    The edges are the exact values at the shares 1 / bins, 2 / bins and so on.
    """
    counts = materialize(table.filter("n > 0 AND x IS NOT NULL AND NOT isnan(x)").groupBy("i", "x", "label").agg(F.sum("n").cast("long").alias("n")))
    values = counts.groupBy("i", "x").agg(F.sum("n").alias("n"))
    totals = values.groupBy("i").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("values")).collect()  # a row per column
    if not totals:
        return {}
    spark = table.sparkSession
    shares = [b / bins for b in range(1, bins)]
    wanted = [(r["i"], [max(1, math.ceil(r["total"] * p - 1e-9)) for p in shares]) for r in totals]
    ranks = F.broadcast(spark.createDataFrame(wanted, "of_i int, ranks array<long>"))
    chunked = ranges(values, ["i", "x"], sum(r["values"] for r in totals), range_rows)
    sums = chunked.groupBy("i", "chunk").agg(F.sum("n").alias("sum"))
    chain = Window.partitionBy("i").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("i", "chunk", F.coalesce(F.sum("sum").over(chain), F.lit(0)).alias("offset"))
    run = Window.partitionBy("i", "chunk").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = chunked.withColumn("run", F.sum("n").over(run)).join(offsets, ["i", "chunk"]).join(ranks, F.col("i") == F.col("of_i"))
    upto = F.col("run") + F.col("offset")
    found = placed.groupBy("i").agg(*[F.min(F.when(upto >= F.col("ranks")[k], F.col("x"))).alias(f"e{k}") for k in range(len(shares))]).collect()
    edges = spark.createDataFrame([(r["i"], sorted({r[f"e{k}"] for k in range(len(shares))})) for r in found], "of_i int, edges array<double>")
    above = F.size(F.filter("edges", lambda e: F.col("x") > e)).cast("double")
    bin_ = F.when(F.col("i").isin(list(whole)), F.col("x")).otherwise(above) if whole else above
    cells = counts.join(F.broadcast(edges), F.col("i") == F.col("of_i")).groupBy("i", bin_.alias("bin"), "label").agg(F.sum("n").alias("n"))
    by_bin = Window.partitionBy("i", "bin")
    by_class = Window.partitionBy("i", "label")
    summed = cells.select("i", "n", F.sum("n").over(by_bin).alias("of_bin"), F.sum("n").over(by_class).alias("of_class"), F.sum("n").over(Window.partitionBy("i")).alias("total"))
    gain = F.col("n") / F.col("total") * F.log(F.col("n").cast("double") * F.col("total") / (F.col("of_bin") * F.col("of_class").cast("double")))
    return {r["i"]: max(0.0, r["mi"]) for r in summed.groupBy("i").agg(F.sum(gain).alias("mi")).collect()}
