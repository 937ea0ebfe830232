"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.graph import join_ids
from tidemill.session import stage

WEIGHTS = (3, 1, 2)
SHARE, EPOCHS, SEED = 1.5, 2, 7
WORD = r"[^\x20\x09-\x0D]+"
_STEP = 12  # bits of the sampling hash that each of two histograms looks at


def numbered(rows: DataFrame, *order) -> DataFrame:
    """``rows`` with ``place`` 0, 1, 2, ... in the given order, counted in ranges that are added up after."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = stage(ranged.withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id()), "ranged")
    sizes = kept.groupBy("_part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("_part")) - F.col("n")  # one row per range
    offsets = sizes.select("_part", before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy("_id")) - 1
    placed = kept.withColumn("_at", inside).join(offsets, "_part")
    return placed.withColumn("place", F.col("_before") + F.col("_at")).drop("_part", "_id", "_at", "_before")


def water_filled(sources: DataFrame, share: float, epochs: float) -> DataFrame:
    """Add ``target`` to stored ``(source, source_size, weight)``.

    All sources rise by weight; one that reaches ``epochs`` times its size is clamped there and its
    excess goes to the others by weight, until none is above. One sum over the table per round.
    """
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    cap = F.col("source_size") * F.lit(float(epochs))
    level = -1.0
    while True:
        open_ = cap >= F.col("weight") * F.lit(level)
        taken, free = sources.agg(
            F.coalesce(F.sum(F.when(~open_, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(open_, F.col("weight"))), F.lit(0)),
        ).first()
        if not free:
            return sources.withColumn("target", cap)
        higher = (share * total - taken) / free
        if higher <= level:
            return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))
        level = higher


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken``, the words the mix takes from each row.

    Size is the number of words. Sources in code point order, null last, weigh ``weights`` in turn and share
    ``share`` times all sizes, each stopping at ``epochs`` times its own. A source's rows are all taken
    the whole number of times in target/size; the rest is a sample: rows whose seeded hash of the id lies
    under a cut, chosen from two histograms of sizes over the hash so that the words come as near the target as
    a step of 24 hash bits allows. The same table and seed give the same mix.

    Null and empty texts have size 0 and are taken 0 times; rows that repeat an id, or a text where they have no id, are taken
    alike; a source without words
    has target 0. Own columns named like the four new ones are replaced.
    """
    docs = docs.drop("size", "source_size", "target", "taken")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    drawn = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(seed), "text")).otherwise(F.xxhash64(F.lit(seed), "doc_id"))
    first = F.shiftrightunsigned(drawn, 64 - _STEP)
    fine = F.shiftrightunsigned(drawn, 64 - 2 * _STEP)
    sizes = stage(docs.select("source", size.alias("size"), first.alias("first"), fine.alias("fine")), "sizes")

    by_first = stage(sizes.groupBy("source", "first").agg(F.sum("size").alias("size")), "histogram")
    sources = by_first.groupBy("source").agg(F.sum("size").alias("source_size"))
    turns = F.array(*[F.lit(w) for w in weights])
    sources = numbered(sources, F.col("source").isNull(), F.col("source"))
    sources = sources.withColumn("weight", F.element_at(turns, (F.col("place") % len(weights) + 1).cast("int")))
    sources = water_filled(stage(sources.drop("place"), "sources"), share, epochs)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate)
    plan = sources.withColumn("whole", whole).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size")
    )
    plan = stage(plan.drop("weight"), "plan")

    up_to = Window.partitionBy("source").orderBy("first")
    crossing = (
        by_first.withColumn("upto", F.sum("size").over(up_to))
        .join(plan.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s")))
        .where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("size") <= F.col("rest")))
        .select("s", F.col("first").alias("f"), (F.col("rest") - F.col("upto") + F.col("size")).alias("need"))
    )
    inside = sizes.join(crossing, F.col("source").eqNullSafe(F.col("s")) & (F.col("first") == F.col("f")))
    steps = inside.groupBy("source", "fine").agg(F.sum("size").alias("size"), F.first("need").alias("need"))
    upto = F.sum("size").over(Window.partitionBy("source").orderBy("fine"))
    # a step is in if more than half of it is needed
    cuts = steps.where("size > 0").withColumn("in", upto - F.col("size") / 2 <= F.col("need"))
    cuts = cuts.groupBy("source").agg(
        F.coalesce(F.max(F.when(F.col("in"), F.col("fine"))), F.min("fine") - 1).alias("last")
    )
    cuts = cuts.toDF("c", "last")
    plan = plan.join(cuts, F.col("source").eqNullSafe(F.col("c")), "left").select(
        F.col("source").alias("_source"), "source_size", "target", F.col("whole").alias("__whole"),
        F.coalesce("last", F.lit(-1)).alias("__last"), F.coalesce("source", F.lit("")).alias("__s"),
        F.col("source").isNull().alias("__n"),
    )
    plan = stage(plan.drop("_source"), "plan")
    rows = docs.withColumn("__s", F.coalesce("source", F.lit(""))).withColumn("__n", F.col("source").isNull())
    rows = join_ids(rows, plan, ["__s", "__n"])
    times = F.col("__whole") + (fine <= F.col("__last")).cast("bigint")
    return rows.withColumn("size", size).select(
        *docs.columns, "size", "source_size", "target", (F.col("size") * times).alias("taken")
    )


def repeated(mixed: DataFrame) -> DataFrame:
    """The rows of a mix as often as it takes them; rows without words are not in it."""
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    copies = F.explode(F.array_repeat(F.lit(1), times)).alias("_copy")
    return mixed.select("*", copies).drop("size", "source_size", "target", "taken", "_copy")
