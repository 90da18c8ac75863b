"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its shuffled documents, repeated up to ``epochs`` times. A document's
virtual finish time is the number of the source's words up to and including it, divided by the
source's weight. Served in order of finish time and cut at the total budget, each source gets words
in proportion to its weight, and what an exhausted source leaves goes to the others by weight: the
level at which min(epochs x size, weight x level) sums to the budget is the fair share.

No source and no range of finish times is ever held by one task: positions inside a source are sums
over 4096 buckets of the shuffle key, and the cut is found by summing ranges of finish times, each
pass splitting the range that holds it. Only the last, small range is sorted.

Null texts have size 0; documents without words are never taken. A null source is a source of its
own, after all others. Repeated rows are separate documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgercast.llm.words import word_count
from ledgercast.session import stage_path
from ledgercast.sources.stages import staged

RANGES = 4096
SMALL_RANGE = 100_000


def default_weight(rank: Column) -> Column:
    """Weights 1, 2, 3, repeating, over the sources in order."""
    return (F.pmod(rank - 1, F.lit(3)) + 1).cast("long")


def source_targets(sizes: DataFrame, epochs: int, weight=default_weight) -> DataFrame:
    """``source_key, source_size, rank, weight, level, target`` for ``(source_key, source_size)``.

    Sources are taken by the level at which they run dry, epochs x size / weight. With the first k of
    them dry the others share what is left; the first k whose level no further source falls below is
    the fair one, and the highest of those. The table has one row per source.
    """
    order = Window.orderBy(F.col("source_key") == "", "source_key")
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = sizes.withColumn("rank", F.row_number().over(order).cast("long"))
    ranked = ranked.withColumns({"weight": weight(F.col("rank")), "cap": F.col("source_size") * F.lit(epochs)})
    ranked = ranked.withColumn("dry_at", F.col("cap").cast("double") / F.col("weight").cast("double"))
    by_level = Window.orderBy("dry_at", "rank")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    left = total - F.coalesce(F.sum("cap").over(before), F.lit(0))
    shared = ranked.withColumn("try", left.cast("double") / F.sum("weight").over(from_here).cast("double"))
    fits = F.when(F.col("try") <= F.col("dry_at"), F.col("try"))
    level = F.coalesce(F.max(fits).over(everything), F.lit(0.0))
    return shared.withColumn("level", level).select(
        "source_key", "source_size", "rank", "weight", "level",
        F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")).alias("target"),
    )


def finish_time(epoch: int) -> Column:
    """Virtual finish time of a document's copy in the given epoch, from 0."""
    words = F.lit(epoch) * F.col("source_size") + F.col("position")
    return words.cast("double") / F.col("weight").cast("double")


def queue_positions(docs: DataFrame, epochs: int, weight=default_weight, digest: bool = False) -> DataFrame:
    """Every row with its size, its source's plan and ``position``: words of its source up to it."""
    spark = docs.sparkSession
    names = ["doc_id"] if digest else docs.columns
    size = word_count(F.col("text"))
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), size.cast("string")))
    source_key = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), F.col("source").cast("string")))
    queued = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        source_key.alias("source_key"), size.alias("size"), key.alias("key"),
    ).withColumn("bucket", F.substring("key", 1, 3))
    if digest:
        queued = staged(queued, stage_path(spark, "queued"))
    buckets = queued.groupBy("source_key", "bucket").agg(F.sum("size").alias("bucket_size"))
    buckets = staged(buckets, stage_path(spark, "buckets"))
    sizes = buckets.groupBy("source_key").agg(F.sum("bucket_size").alias("source_size"))
    earlier = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.withColumn("offset", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)))
    plan = offsets.join(source_targets(sizes, epochs, weight), "source_key").drop("bucket_size")
    up_to = Window.partitionBy("source_key", "bucket").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = queued.join(plan, ["source_key", "bucket"]).select(
        "row", "size", "source_size", "rank", "weight", "level", "target",
        (F.sum("size").over(up_to) + F.col("offset")).alias("position"),
    )
    return staged(placed, stage_path(spark, "positions"))


def find_cut(placed: DataFrame, epochs: int) -> tuple[float, int] | None:
    """Finish time and source rank of the last copy inside the budget, the sum of all sizes.

    Inside a source finish times rise strictly, so a tie is between sources and the rank settles it.
    """
    budget, highest = placed.agg(F.sum("size"), F.max(finish_time(epochs - 1))).first()
    if not budget:
        return None
    copies = placed.where("size > 0").select(
        "size", "rank", F.explode(F.array(*[finish_time(e) for e in range(epochs)])).alias("finish")
    )
    low, high, served = 0.0, highest, 0
    while True:
        inside = copies.where((F.col("finish") >= low) & (F.col("finish") <= high))
        width = (high - low) / RANGES
        part = F.least(F.lit(RANGES - 1), F.floor((F.col("finish") - F.lit(low)) / F.lit(width or 1.0))).cast("int")
        sums = inside.groupBy(part.alias("part")).agg(
            F.sum("size").alias("size"), F.count("*").alias("n"), F.min("finish").alias("first"), F.max("finish").alias("last")
        )
        crossing = None
        for row in sorted(sums.collect(), key=lambda r: r["part"]):  # at most RANGES rows
            crossing = row
            if served + row["size"] > budget:
                break
            served += row["size"]
        if crossing["n"] <= SMALL_RANGE or crossing["first"] == crossing["last"]:
            break
        low, high = crossing["first"], crossing["last"]
    order = Window.orderBy("finish", "rank").rowsBetween(Window.unboundedPreceding, 0)
    last_range = copies.where((F.col("finish") >= crossing["first"]) & (F.col("finish") <= crossing["last"]))
    fitting = last_range.withColumn("served", F.sum("size").over(order)).where(F.col("served") <= budget - served)
    last = fitting.agg(F.max(F.struct("finish", "rank")).alias("cut")).first()["cut"]
    if last is None:
        last = copies.where(F.col("finish") < crossing["first"]).agg(F.max(F.struct("finish", "rank")).alias("cut")).first()["cut"]
    return (last["finish"], last["rank"]) if last else None


def copies_taken(cut: tuple[float, int] | None, epochs: int) -> Column:
    """How many times the mix takes a document."""
    if cut is None:
        return F.lit(0).cast("long")
    taken = F.lit(0).cast("long")
    for epoch in range(epochs):
        finish = finish_time(epoch)
        inside = (finish < cut[0]) | ((finish == cut[0]) & (F.col("rank") <= cut[1]))
        taken = taken + F.when(inside & (F.col("size") > 0), F.lit(1)).otherwise(F.lit(0)).cast("long")
    return taken


def mix_digest(docs: DataFrame, epochs: int = 3) -> DataFrame:
    """What the mix takes of every row, in words, beside its source's size and target."""
    placed = queue_positions(docs, epochs, digest=True)
    taken = copies_taken(find_cut(placed, epochs), epochs)
    return placed.select("row.doc_id", "size", "source_size", "target", (taken * F.col("size")).alias("taken"))


def mix_documents(docs: DataFrame, epochs: int = 3, weight=default_weight) -> DataFrame:
    """The mix itself: every row as often as it is taken, in its own columns."""
    placed = queue_positions(docs, epochs, weight)
    taken = copies_taken(find_cut(placed, epochs), epochs).cast("int")
    repeated = placed.select("row", taken.alias("copies")).where("copies > 0")
    return repeated.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")
