"""Mixing sources to target weights by a low-discrepancy schedule.

Slot i of the schedule has the point frac(i / golden ratio).  The points are mapped
through the cumulative target shares to sources, so every stretch of the schedule
holds each source close to its share.  The documents of a source, in an order
shuffled by a seeded hash, are one stream of words cut into blocks of equal size;
the slots of a source are ranked, and slot r takes block r, from the start again
after the last block.  A source's last slot is cut to its target, slots beyond the
target are left empty, and a source that the schedule gave too few gets the rest
at the end: it takes its target to the word, and no document is taken more often
than its source.

Targets are a budget shared by weight; a source's target stops at a cap, and what it
cannot use is shared again among the others by weight.

Defined results: null and empty texts have size 0 and nothing is taken from them; a
null source is a source, the last; repeated rows are rows of their own; other
columns are ignored; an empty table gives an empty mix.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subrev.llm.common import Scratch, fresh
from subrev.llm.prefix import _join, running_sum

SEED = 1618
BLOCK_WORDS = 4096
#: Rows that one bucket of a shuffled stream holds about.
BUCKET_ROWS = 20_000
SLOT_BUCKET = 50_000
GRID = 4096
_SPLIT = 1 << 20
#: 1 / golden ratio, and the fraction of _SPLIT times it, each to the last bit of a double.
_GOLDEN = (Decimal(5).sqrt() - 1) / 2
_GOLDEN_SPLIT = float(_SPLIT * _GOLDEN % 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def golden(i: Column) -> Column:
    """frac(i / golden ratio), split so that large i keep their precision."""
    high, low = F.floor(i / _SPLIT), i % _SPLIT
    x = high * F.lit(_GOLDEN_SPLIT) + low * F.lit(float(_GOLDEN))
    return x - F.floor(x)


def targets(sizes: DataFrame, weights: tuple[float, ...], budget: float, cap: float) -> DataFrame:
    """(source, source_size, target, words, from, to): one row per source of ``sizes`` (source, source_size).

    Sources by code point, null last, take the weights in turn.  A target is the lesser
    of cap * size and weight * level, with the one level that uses the budget up.
    ``words`` is the target as whole words, ``from`` and ``to`` its share of the schedule.
    The table has one row per source, so its windows are as small as the mix.
    """
    ranked = sizes.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    wheel = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    rows = ranked.withColumn("_w", wheel).withColumn("_cap", F.col("source_size") * cap)
    every = Window.partitionBy()
    by_cap = Window.orderBy(F.col("_cap") / F.col("_w"), "_rank")
    capped = F.sum("_cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1))
    open_weight = F.sum("_w").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("_budget", F.sum("source_size").over(every) * budget) \
        .withColumn("_level", (F.col("_budget") - F.coalesce(capped, F.lit(0.0))) / open_weight)
    # the first source, in order of its cap per weight, that the level leaves below its cap sets the level of all from it on
    level = F.min(F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.struct(F.col("_cap") / F.col("_w"), "_rank", F.col("_level").alias("level")))).over(every)
    target = F.when(level.isNull(), F.col("_cap")).otherwise(F.least("_cap", level["level"] * F.col("_w")))
    rows = rows.withColumn("target", target).withColumn("words", F.round("target").cast("bigint"))
    upto = F.sum("words").over(Window.orderBy("_rank"))
    total = F.sum("words").over(every)
    return rows.select("source", "source_size", "target", "words", F.try_divide(upto - F.col("words"), total).alias("from"),
                       F.try_divide(upto, total).alias("to"))


def slots(plan: DataFrame, n_slots: int, block: int) -> DataFrame:
    """(source, block, take, slot): which words of a block each slot takes, counted from the block's start."""
    points = plan.sparkSession.range(n_slots).withColumn("x", golden(F.col("id") + 1))
    cell = lambda c: F.least(F.floor(F.col(c) * GRID), F.lit(GRID - 1))
    shares = plan.where("words > 0").select("source", "from", "to", F.explode(F.sequence(cell("from"), cell("to"))).alias("cell"))
    mapped = points.withColumn("cell", cell("x")).join(shares, "cell").where((F.col("x") >= F.col("from")) & (F.col("x") < F.col("to")))
    mapped = mapped.select("source", "id", F.floor(F.col("id") / SLOT_BUCKET).alias("chunk"), F.lit(1).alias("one"))
    ranked = running_sum(mapped, ["source"], "chunk", ["id"], "one", "r").select("source", "r", F.col("id").alias("slot"))
    per_pass = F.ceil(F.col("source_size") / block)
    full = F.floor(F.col("words") / F.col("source_size"))
    need = plan.where("words > 0").withColumn("per_pass", per_pass).withColumn(
        "n", full * per_pass + F.ceil((F.col("words") - full * F.col("source_size")) / block))
    given = ranked.groupBy("source").agg(F.count("*").alias("given"))
    late = need.join(given.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left") \
        .select("source", F.coalesce("given", F.lit(0)).alias("given"), "n").where("given < n") \
        .select("source", F.explode(F.sequence("given", F.col("n") - 1)).alias("r"), F.lit(n_slots).cast("bigint").alias("slot"))
    rows = ranked.unionByName(late)
    info = need.select(F.col("source").alias("_s"), "source_size", "words", "per_pass", "n")
    rows = rows.join(info, F.col("source").eqNullSafe(F.col("_s"))).where("r < n")
    at = (F.col("r") % F.col("per_pass")) * block
    before = F.floor(F.col("r") / F.col("per_pass")) * F.col("source_size") + at
    take = F.least(F.lit(block), F.col("source_size") - at, F.col("words") - before)
    return rows.select("source", (F.col("r") % F.col("per_pass")).alias("block"), take.alias("take"), "slot")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), budget: float = 1.5, cap: float = 2.0,
        block: int = BLOCK_WORDS, seed: int = SEED, keep_hash: bool = False) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, first_slot) of every row.

    ``taken`` counts the words the mix takes from the row, repeats included;
    ``first_slot`` is the earliest slot of the schedule that takes any; ``keep_hash`` adds ``h``, the row's hash.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    rows = scratch.keep("sizes", docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                                             F.xxhash64(F.lit(seed), "doc_id", "text").alias("h")))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    plan = scratch.keep("plan", targets(sizes.select("source", "source_size"), weights, budget, cap))
    total, n_rows = plan.agg(F.sum("words")).first()[0] or 0, sizes.agg(F.sum("n")).first()[0] or 0
    extra = ["h"] if keep_hash else []
    if not total:
        return _join(rows, plan, ["source"], take="target").select(
            "doc_id", "source", *extra, "size", F.lit(0).cast("bigint").alias("source_size"), "target", F.lit(0).cast("bigint").alias("taken"),
            F.lit(None).cast("bigint").alias("first_slot"))
    bits = max(0, (n_rows // BUCKET_ROWS).bit_length())
    bucket = F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("bigint")
    placed = running_sum(rows.withColumn("bucket", bucket), ["source"], "bucket", ["h", "doc_id", "size"], "size", "start")
    placed = scratch.keep("placed", placed.select("doc_id", "source", *extra, "size", "start"))
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    pieces = placed.where("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    slot = slots(plan, -(-total // block), block).select(F.col("source").alias("_s"), F.col("block").alias("_b"), "take", "slot")
    low = F.greatest(F.col("start") - F.col("block") * block, F.lit(0))
    high = F.least(F.col("start") + F.col("size") - F.col("block") * block, F.lit(block))
    words = F.when(F.col("take").isNotNull(), F.greatest(F.least(high, F.col("take")) - low, F.lit(0))).otherwise(0)
    met = pieces.join(slot, (F.col("block") == F.col("_b")) & F.col("source").eqNullSafe(F.col("_s")), "left")
    taken = met.groupBy("doc_id", "source", *extra, "size", "start").agg(
        F.sum(words).alias("taken"), F.min(F.when(words > 0, F.col("slot"))).alias("first_slot"))
    every = taken.select("doc_id", "source", *extra, "size", "taken", "first_slot").unionByName(
        placed.where("size = 0").select("doc_id", "source", *extra, "size", F.lit(0).cast("bigint").alias("taken"), F.lit(None).cast("bigint").alias("first_slot")))
    info = plan.select(F.col("source").alias("_s"), "source_size", "target")
    return every.join(info, F.col("source").eqNullSafe(F.col("_s"))).select(
        "doc_id", "source", *extra, "size", "source_size", "target", "taken", "first_slot")


def take_documents(docs: DataFrame, seed: int = SEED, **options: object) -> DataFrame:
    """``docs`` as the mix takes them, in whole documents: each row as often as its words taken make up its size, rounded.

    Rows without words have no share of a mix and are not taken.  Rows that agree in doc_id,
    source and text are taken equally often.
    """
    mixed = mix(docs, seed=seed, keep_hash=True, **options).where("taken > 0")
    copies = mixed.groupBy("doc_id", "source", "h").agg(F.round(F.sum("taken") / F.sum("size")).cast("int").alias("n")).where("n > 0")
    h, n = fresh("mix_hash", docs.columns), fresh("mix_copies", docs.columns)
    right = copies.select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("h").alias("_h"), F.col("n").alias(n))
    rows = docs.withColumn(h, F.xxhash64(F.lit(seed), "doc_id", "text"))
    met = rows.join(right, (F.col(h) == F.col("_h")) & F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s")))
    return met.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(n))).alias(fresh("mix_copy", docs.columns))).select(*docs.columns)
