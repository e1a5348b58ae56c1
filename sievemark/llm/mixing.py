"""Mixing sources to target weights along a time-varying curriculum.

Targets. Sources, by code point with null last, weigh 1, 2, 3, 1, ... and share the total size by weight. A target stops at
CEILING times its source's size; the excess is shared anew by weight. That is one level: the target is the lesser of the
ceiling and the weight times a level at which the targets add up to the total. Sorting sources by ceiling over weight, the
level follows from running sums.

Curriculum. The weight of a source changes over training progress p from 0 to 1 as weight * (1 + slope * (2p - 1)), with a
slope for each of the three weights; its integral is the weight, so that targets hold over the whole run. A source's
cumulative demand at p is target * (p + slope * (p*p - p)). Its documents, in an order fixed by a hash of their id and
repeated up to CEILING times, fill that demand; inverting the demand at the middle of a copy's words gives its position in
training, so that every copy stands where the schedule asks for its words, and copies are range-sorted by position. A copy is
taken if its middle lies below the target, so that what is taken differs from the target by half a document at most.

Defined results. Null text has size 0 and is never taken. A null source is a source of its own. The order of a source is that
of a hash of doc_id and text, so that null or repeated doc_ids are spread too; equal rows count one by one. An empty table
gives no rows. Other columns are not read.

At scale: words are counted in one pass. Running sums over a source, which may hold a third of all rows, are taken in two
levels: within ranges of the hash (about the square root of the source's rows in each), and over the ranges. All of it is
DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

WORD = r"[^\x20\x09-\x0D]+"
CEILING = 3
#: Slope of the weights 1, 2 and 3 over the run: light sources early, heavy ones late.
SLOPES = (-0.5, 0.0, 0.5)


def targets(sizes: DataFrame, slopes: tuple[float, float, float] = SLOPES, ceiling: int = CEILING) -> DataFrame:
    """source, n, source_size, weight, slope, target, place of every source. sizes: source, n, source_size."""
    named = Window.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("place", F.row_number().over(named)).withColumn("weight", (F.col("place") - 1) % 3 + 1)
    w = w.withColumn("most", F.col("source_size") * ceiling)
    filled = Window.orderBy(F.col("most") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.col("most") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("most").over(filled), F.lit(0))
    left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filled), F.lit(0))
    total = F.sum("source_size").over(everything)
    w = w.withColumn("level", (total - before).cast("double") / left.cast("double"))
    # the running levels rise while sources reach their ceiling below them, and fall after
    w = w.withColumn("at", F.max("level").over(everything))
    slope = F.element_at(F.array(*(F.lit(float(x)) for x in slopes)), F.col("weight").cast("int"))
    return w.select("source", "n", "source_size", "place", "weight", slope.alias("slope"), F.least(F.col("most").cast("double"), F.col("at") * F.col("weight")).alias("target"))


def position(share, slope):
    """Training progress at which a source's cumulative demand reaches this share of its target."""
    root = (F.sqrt((1 - slope) * (1 - slope) + 4 * slope * share) - (1 - slope)) / (2 * slope)
    return F.when(slope == 0, share).otherwise(root)


def mix(docs: DataFrame, keep: bool = False, slopes: tuple[float, float, float] = SLOPES, ceiling: int = CEILING) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, positions (of each copy taken) of every row, range-sorted by the first position. keep: with all columns of docs, as the struct `doc`, and in no order."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))
    order = F.conv(F.substring(F.md5(named.cast("binary")), 1, 15), 16, 10).cast("long")
    rows = docs.select("doc_id", "source", size.alias("size"), order.alias("o"), *([F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")] if keep else []))
    if not keep:
        rows = written(rows, "sizes")
    sums = rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    plan = written(targets(sums, slopes, ceiling).withColumn("ranges", F.ceil(F.sqrt("n")).cast("long")), "targets")
    cut = F.shiftright(F.shiftright("o", 20) * F.col("ranges"), 40)
    known = plan.withColumnRenamed("source", "of")
    # a bounded part of the rows' own columns goes into the running sums, which are all that the second pass needs
    ranged = rows.join(known, rows["source"].eqNullSafe(known["of"]), "left").withColumn("range", cut)
    sums = ranged.groupBy("place", "range").agg(F.sum("size").alias("held"))
    earlier = Window.partitionBy("place").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(sums.withColumn("start", F.coalesce(F.sum("held").over(earlier), F.lit(0))).select("place", "range", "start"), "starts")
    within = Window.partitionBy("place", "range").orderBy("o", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = ranged.withColumn("through", F.sum("size").over(within)).join(starts, ["place", "range"])
    filled = filled.withColumn("begin", F.col("start") + F.col("through") - F.col("size"))
    at = []
    for j in range(ceiling):
        middle = 2 * (F.col("begin") + j * F.col("source_size")) + F.col("size")
        at.append(F.when((F.col("size") > 0) & (middle < 2 * F.col("target")), position(middle.cast("double") / (2 * F.col("target")), F.col("slope"))))
    out = filled.withColumn("positions", F.filter(F.array(*at), lambda x: x.isNotNull())).withColumn("copies", F.size("positions").cast("long"))
    columns = ["doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "positions"]
    if keep:
        return out.select(*columns, "doc")
    return out.select(*columns).orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), "doc_id")


def training_order(mixed: DataFrame) -> DataFrame:
    """One row for every copy that a mix with keep takes, range-sorted by its position: the columns of the document, then those of the mix that have other names, copy (from 0) and position."""
    own = mixed.schema["doc"].dataType.names
    added = [c for c in ("size", "source_size", "target", "taken", "copies") if c not in own]
    each = mixed.select(*(F.col("doc").getField(c).alias(c) for c in own), *added, F.posexplode("positions").alias("_copy", "_position"))
    last = [(F.col(c), c.removeprefix("_")) for c in ("_copy", "_position")]
    return each.orderBy("_position", "doc_id", "_copy").select(*own, *added, *(c.alias(n) for c, n in last if n not in own))
