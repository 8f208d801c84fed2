"""Mixing sources to target weights by a curriculum that varies over training time.

Training time runs from 0 to 1. Every source has a weight schedule, a piecewise linear function given
by its knots. The integral of a schedule is the source's weight in the whole mix; the integral up to
time t is its demand by then. Inverting the demand gives the training position of each of its words:
a document begins where the demand reaches the words that its source has given before it.

1. One scan counts the words of every text; texts stay behind.
2. Sources are ranked by code point (null last) and take the schedules in turn. Their weights share the
   words of the corpus; a source gives each word ``passes`` times at most, and what it can't give is
   shared anew by weight until no target is above that (water filling, in closed form: sources in
   order of what they can give per weight).
3. Within a source documents stand in an order drawn by hash; a running sum gives the words before each.
   A pass begins again behind the last word of the one before. The last document is cut at the target.
4. The demand is inverted at each document's first word of each pass, and documents are range-sorted by
   their first position.

All steps are DataFrame functions. Running sums (ranks, water filling, words) are distributed: rows are
range-partitioned, summed inside each partition, and each partition's base comes from a table of one
row per partition and group; a source that holds a third of all rows is many partitions.

Defined results: null and empty texts have no words, take no part and have no position. A null source
is a source of its own. Null ids are kept and stand last among equal hashes; rows that repeat an id are
documents of their own. A source without words has target 0; so have all when the corpus has none.
An empty table gives no rows; extra columns are ignored. Reruns agree, whatever the partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripsight.llm.common import handover, parts

#: Knots (training time, weight) of a schedule, from time 0 to time 1.
Schedule = Sequence[tuple[float, float]]
#: Schedules of integral 1, 2 and 3: one fades out, one holds, one comes in.
FADING, STEADY, RISING = [(0.0, 1.5), (1.0, 0.5)], [(0.0, 2.0), (1.0, 2.0)], [(0.0, 2.0), (0.5, 3.0), (1.0, 4.0)]
SCHEDULES = (FADING, STEADY, RISING)
PASSES = 3
#: Weights are counted in decimals, so that their sums don't depend on the order of rows.
_WEIGHT = "decimal(28,9)"


def integral(knots: Schedule) -> list[float]:
    """The schedule's integral from time 0 to each of its knots."""
    out = [0.0]
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        out.append(out[-1] + (t1 - t0) * (w0 + w1) / 2)
    return out


def check_schedules(schedules: Sequence[Schedule]) -> None:
    for knots in schedules:
        times, weights = [t for t, _ in knots], [w for _, w in knots]
        if len(knots) < 2 or times[0] != 0 or times[-1] != 1 or times != sorted(set(times)):
            raise ValueError("a schedule's knots must ascend from time 0 to time 1")
        if min(weights) < 0 or not integral(knots)[-1] > 0:
            raise ValueError("a schedule's weights must not be negative, nor all zero")


def _by_class(which: Column, values: Sequence[Column]) -> Column:
    out = values[-1]
    for i, v in enumerate(values[:-1]):
        out = F.when(which == i, v).otherwise(out)
    return out


def time_of(demand: Column, which: Column, schedules: Sequence[Schedule]) -> Column:
    """Training time at which the schedule of class ``which`` has given the share ``demand`` of its integral."""
    pieces, totals = [], []
    for knots in schedules:
        cum = integral(knots)
        totals.append(F.lit(cum[-1]))
        pieces.append(F.array(*[F.struct(F.lit(t0).alias("t"), F.lit(w0).alias("w"),
                                         F.lit((w1 - w0) / (t1 - t0)).alias("slope"), F.lit(c).alias("before"))
                                for (t0, w0), (t1, w1), c in zip(knots, knots[1:], cum)]))
    asked = demand * _by_class(which, totals)
    at = F.try_element_at(F.filter(_by_class(which, pieces), lambda s: s["before"] <= asked), F.lit(-1))
    rest = asked - at["before"]
    # root of w x + slope x^2 / 2 = rest, in the form that cancels nothing
    x = F.try_divide(2 * rest, at["w"] + F.sqrt(F.greatest(at["w"] * at["w"] + 2 * at["slope"] * rest, F.lit(0.0))))
    return F.least(at["t"] + F.coalesce(x, F.lit(0.0)), F.lit(1.0))


def running_sums(df: DataFrame, order: list, values: dict[str, str], by: list[str], name: str) -> DataFrame:
    """``df`` with, for each ``{new: value}``, the sum of ``value`` over the rows before in its ``by`` group.

    Rows are range-partitioned by group and order, so a large group is spread over many partitions.
    """
    spark = df.sparkSession
    dealt = handover(df.repartitionByRange(parts(spark), *by, *order).withColumn("_part", F.spark_partition_id()), name)
    here = (Window.partitionBy("_part", *by).orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, -1))
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition and group: at most partitions + groups rows
    sums = dealt.groupBy("_part", *by).agg(*[F.sum(v).alias(n) for n, v in values.items()])
    bases = sums.select("_part", *by, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_{n}") for n in values])
    out = dealt.select("*", *[F.coalesce(F.sum(v).over(here), F.lit(0)).alias(n) for n, v in values.items()])
    out = out.join(handover(bases, f"{name}-bases"), ["_part", *by])
    return out.select(*df.columns, *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in values])


def source_targets(sized: DataFrame, schedules: Sequence[Schedule], passes: int) -> DataFrame:
    """source, rank, class, source_size, target: what each source gives to a mix as large as the corpus."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running_sums(sources.withColumn("one", F.lit(1)), [F.col("source").asc_nulls_last()], {"rank": "one"},
                          [], "curriculum-sources")
    weights = [F.lit(integral(s)[-1]).cast(_WEIGHT) for s in schedules]
    which = F.pmod("rank", F.lit(len(schedules))).cast("int")
    caps = (ranked.select("source", "rank", which.alias("class"), "source_size",
                          _by_class(which, weights).alias("weight"), (F.col("source_size") * passes).alias("cap"))
            .withColumn("ratio", F.col("cap") / F.col("weight").cast("double")))
    filled = handover(running_sums(caps, ["ratio", "rank"], {"cap_before": "cap", "weight_before": "weight"}, [],
                                   "curriculum-caps"), "curriculum-filled")
    words, weight = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    words, weight = int(words or 0), weight or 0
    # capped in this order as long as the share of what is left lies above the cap
    left = F.lit(words) - F.col("cap_before")
    open_weight = (F.lit(weight).cast(_WEIGHT) - F.col("weight_before")).cast("double")
    capped = F.col("weight").cast("double") * left > F.col("cap") * open_weight
    judged = filled.withColumn("capped", capped)
    taken, rest = judged.agg(F.sum(F.when(F.col("capped"), F.col("cap"))),
                             F.sum(F.when(~F.col("capped"), F.col("weight")))).first()
    share = F.try_divide(F.col("weight").cast("double") * F.lit(float(words - int(taken or 0))), F.lit(float(rest or 0)))
    cap = F.col("cap").cast("double")
    return judged.select("source", "rank", "class", "source_size",
                         F.when(F.col("capped"), cap).otherwise(F.least(cap, F.coalesce(share, F.lit(0.0))))
                         .alias("target"))


def curriculum(docs: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, passes: int = PASSES, seed: int = 0
               ) -> DataFrame:
    """One row per document, range-sorted by its first training position (documents not taken last).

    doc_id, source, size, source_size, target (its source's words in the mix), taken, and for each pass that
    takes it the training time of its first word (``positions``) and the words taken (``words``).
    """
    check_schedules(schedules)
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = handover(docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"),
                                 drawn.alias("drawn")), "curriculum-sizes")
    targets = handover(source_targets(sized, schedules, passes), "curriculum-targets")
    # the written targets are as small as the sources are few; Spark joins them by their size
    of = targets.withColumnRenamed("source", "s")
    joined = (sized.join(of, F.col("source").eqNullSafe(F.col("s")))
              .select("doc_id", "source", "size", "drawn", "rank", "class", "source_size", "target"))
    placed = running_sums(joined, ["drawn", F.col("doc_id").asc_nulls_last(), "size"], {"before": "size"}, ["rank"],
                          "curriculum-words")
    limit = F.floor("target").cast("long")

    def one(k: Column) -> Column:
        start = F.col("before") + k * F.col("source_size")
        words = F.greatest(F.least(limit - start, F.col("size")), F.lit(0))
        return F.struct(time_of(F.try_divide(start.cast("double"), F.col("target")), F.col("class"), schedules)
                        .alias("position"), words.alias("words"))

    each = F.filter(F.transform(F.sequence(F.lit(0), F.lit(passes - 1)), one), lambda x: x["words"] > 0)
    out = placed.withColumn("each", each).select(
        "doc_id", "source", "size", "source_size", "target",
        F.aggregate("each", F.lit(0).cast("long"), lambda a, x: a + x["words"]).alias("taken"),
        F.col("each.position").alias("positions"), F.col("each.words").alias("words"))
    return out.orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), "source", "doc_id")


def training_order(mix: DataFrame) -> DataFrame:
    """The mix in training order: position, source, doc_id, pass (from 0), words; one row per document and pass."""
    return (mix.select("source", "doc_id", F.posexplode(F.arrays_zip("positions", "words")).alias("pass", "x"))
            .select(F.col("x.positions").alias("position"), "source", "doc_id", "pass", F.col("x.words").alias("words"))
            .orderBy("position", "source", "doc_id", "pass"))
