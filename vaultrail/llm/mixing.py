"""Mixing sources to target weights by whole copies and Pareto order sampling.

A source's target is its share of all words by weight, at most ``limit`` times its own words; what is cut off goes to
the other sources by weight. Every document is first taken ``floor(target / source size)`` times. The rest of the target is
sampled without replacement: a document has an inclusion probability in proportion to its size; documents larger than the rest are
set aside, and those whose probability would reach 1 are taken, which leaves the others their share of what then is missing. A
document's rank is its random odds divided by its inclusion odds. Going down the ranks, each document that fits into what is still
missing is taken, until no unused one fits. One closing document per source, the one whose size is nearest to
what is still missing, is added if that brings the source nearer to its target.

Running sums within a source never need its rows in one task: ranks are mapped to cells, sums over cells are
formed first, and only the rows of the one cell in which a source's rest runs out are put in order. A round takes all
documents of a source up to the first that no longer fits; the next round goes on behind them with those of at most
the size still missing. So a round is a pass over narrow rows, and its outcome one row a source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultrail.llm.tables import join_narrow, pick
from vaultrail.session import materialise

#: Cells that the ranks of a source are divided into.
CELLS = 1 << 14
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), limit: float = 3.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Weights repeat over the sources in code point order, null last. Caps come from the sources in order of
    the level at which each is full: below that level all get weight times level. The table has one row a source.
    """
    order = Window.orderBy(F.asc_nulls_last("source"))
    full = Window.orderBy("level", F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("level", F.asc_nulls_last("source")).rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    table = sizes.withColumn("weight", F.array(*map(F.lit, map(float, weights)))[(F.row_number().over(order) - 1) % len(weights)])
    table = table.withColumn("level", limit * F.col("source_size") / F.col("weight"))
    table = table.withColumns({"total": F.sum("source_size").over(everything), "capped": F.coalesce(F.sum(limit * F.col("source_size")).over(full), F.lit(0.0)), "open": F.sum("weight").over(rest)})
    # The level that would use up the total if all earlier sources were full and no later one were.
    table = table.withColumn("reach", (F.col("total") - F.col("capped")) / F.col("open"))
    # The first source not full tells the level; after it the quotient only falls.
    table = table.withColumn("final", F.max(F.when(F.col("reach") <= F.col("level"), F.col("reach"))).over(everything))
    target = F.least(limit * F.col("source_size"), F.col("weight") * F.col("final"))
    return table.select("source", F.col("source_size").cast("long").alias("source_size"), target.cast("double").alias("target"))


def taken_copies(documents: DataFrame, weights: tuple[float, ...] = (5, 2, 1), limit: float = 3.0, seed: int = 0) -> DataFrame:
    """Per row: doc_id, size, source, source_size, target, copies, taken (copies times size), h.

    Sizes are words, runs of characters other than space and 0x09 to 0x0D; a null text has none. A null source is a source
    of its own. A document without words is taken as often as whole copies are. Random numbers are hashes of
    ``seed``, doc_id and text, so reruns agree and equal rows stand or fall together except at the edge of a
    sample. ``h`` numbers are the hashes. An empty table gives an empty result.
    """
    rows = pick(documents, "doc_id", "text", "source").select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"))
    rows = materialise(rows, "mix-sizes")
    squares = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size").cast("double") ** 2).alias("square"))
    plan = targets(squares.select("source", "source_size"), weights, limit)
    plan = plan.join(squares.select("source", "square"), plan["source"].eqNullSafe(squares["source"])).select(plan["*"], "square")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(0).cast("long")
    plan = plan.withColumn("whole", whole).withColumn("rest", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
    plan = materialise(plan.withColumnRenamed("source", "origin"), "mix-plan")

    # Documents taken for certain: largest first, as long as a size's share of what is missing without the larger ones reaches 1.
    sizes = join_narrow(rows.where("size > 0").groupBy("source", "size").agg(F.count("*").cast("double").alias("n")), plan, F.col("source").eqNullSafe(F.col("origin")))
    sizes = sizes.where("size <= rest").select("source", "size", "n", "rest")
    larger = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    smaller = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    sizes = sizes.withColumns({"missing": F.col("rest") - F.coalesce(F.sum(F.col("n") * F.col("size")).over(larger), F.lit(0.0)), "square": F.sum(F.col("n") * F.col("size") * F.col("size")).over(smaller)})
    sure = F.col("size") * F.col("missing") >= F.col("square")
    shares = sizes.groupBy("source").agg(F.min(F.when(sure, F.col("size"))).alias("certain"), F.max(F.when(~sure, F.struct("size", F.col("missing").alias("open"), F.col("square").alias("squares")))).alias("o"))
    shares = materialise(shares.select(F.col("source").alias("share_of"), "certain", "o.open", "o.squares"), "mix-shares")

    chance = F.when((F.col("size") > 0) & (F.col("size") <= F.col("rest")), F.when(F.col("size") >= F.col("certain"), 1.0).otherwise(F.col("open") * F.col("size") / F.col("squares")))
    uniform = (F.shiftrightunsigned("h", 11) + 0.5) / float(1 << 53)
    odds = (uniform / (1 - uniform)) * (1 - chance) / chance
    ranked = join_narrow(rows, plan, rows["source"].eqNullSafe(plan["origin"]))
    ranked = join_narrow(ranked, shares, ranked["source"].eqNullSafe(F.col("share_of")), "left").withColumn("rank", F.when(chance > 0, odds))
    # A monotone map of the ranks to cells, even if inclusion odds vary little within a source; the certain ones are in front.
    flat = odds * (F.col("rest") / F.greatest(F.col("source_size") - F.col("rest"), F.lit(1.0)))
    ranked = ranked.withColumn("cell", F.when(chance >= 1, -1).when(chance > 0, F.floor(CELLS * flat / (1 + flat)).cast("int")))
    ranked = materialise(ranked.select("doc_id", "source", "size", "h", "rank", "cell", "rest", F.monotonically_increasing_id().alias("nr")), "mix-ranks")

    # One row a source and round: documents of at most ``missing`` words with a place behind ``start`` and up to ``stop`` are taken.
    place = F.struct("cell", "rank", "h", "nr")
    first = F.struct(F.lit(-2).alias("cell"), F.lit(-1.0).alias("rank"), F.lit(0).cast("long").alias("h"), F.lit(0).cast("long").alias("nr"))
    state = plan.where("rest > 0").select("origin", F.col("rest").alias("missing"), first.alias("start"))
    state, rounds = materialise(state, "mix-round"), []
    before = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    own = Window.partitionBy("source").orderBy("rank", "h", "nr")
    while not state.isEmpty():
        able = join_narrow(ranked.where("cell is not null").drop("rest", "doc_id"), state, F.col("source").eqNullSafe(F.col("origin"))).where(F.col("size") <= F.col("missing")).where(place > F.col("start"))
        cells = able.groupBy("source", "cell", "missing", "start").agg(F.sum("size").alias("sum"))
        cells = cells.withColumn("before", F.coalesce(F.sum("sum").over(before), F.lit(0)))
        # A source without an edge is done: all that is left of it fits.
        edges = cells.groupBy("source").agg(F.first("missing").alias("missing"), F.first("start").alias("start"), F.min(F.when(F.col("before") + F.col("sum") > F.col("missing"), F.struct("cell", "before"))).alias("edge"))
        edges = materialise(edges.select(F.col("source").alias("origin"), "missing", "start", F.col("edge.cell").alias("edge"), "edge.before"), "mix-edge")
        inside = join_narrow(ranked.drop("rest", "doc_id"), edges.where("edge is not null"), F.col("source").eqNullSafe(F.col("origin")) & (F.col("cell") == F.col("edge")))
        inside = inside.where(F.col("size") <= F.col("missing")).where(place > F.col("start")).withColumn("upto", F.col("before") + F.sum("size").over(own))
        last = inside.where(F.col("upto") <= F.col("missing")).groupBy("source").agg(F.max(place).alias("stop"), F.max("upto").alias("got"))
        taken = edges.join(last, F.col("origin").eqNullSafe(F.col("source")), "left")
        # Where none of the edge cell fits, the round ends in front of that cell.
        ahead = F.struct(F.col("edge").alias("cell"), F.lit(-1.0).alias("rank"), F.lit(0).cast("long").alias("h"), F.lit(0).cast("long").alias("nr"))
        taken = taken.select("origin", "missing", "start", F.when(F.col("edge").isNotNull(), F.coalesce("stop", ahead)).alias("stop"), F.coalesce("got", "before").alias("got"))
        taken = materialise(taken, "mix-round")
        rounds.append(taken)
        state = materialise(taken.where("stop is not null and missing > got").select("origin", (F.col("missing") - F.col("got")).alias("missing"), F.col("stop").alias("start")), "mix-round")

    sampled = ranked.withColumn("extra", F.lit(0))
    if rounds:
        steps = rounds[0]
        for x in rounds[1:]:
            steps = steps.unionByName(x)
        steps = materialise(steps.groupBy("origin").agg(F.collect_list(F.struct("start", "stop", "missing")).alias("steps")), "mix-steps")
        took = F.exists("steps", lambda x: (F.col("size") <= x["missing"]) & (place > x["start"]) & (x["stop"].isNull() | (place <= x["stop"])))
        sampled = join_narrow(ranked, steps, F.col("source").eqNullSafe(F.col("origin")), "left").withColumn("extra", F.coalesce(F.col("cell").isNotNull() & took, F.lit(False)).cast("int"))
    sampled = materialise(sampled.select("doc_id", "source", "size", "h", "rest", "extra", "nr"), "mix-sample")

    reached = sampled.groupBy("source").agg(F.sum(F.col("size") * F.col("extra")).alias("got"), F.max("rest").alias("rest"))
    reached = reached.select(F.col("source").alias("origin"), (F.col("rest") - F.col("got")).alias("missing"))
    reached = materialise(reached.where("missing > 0"), "mix-missing")
    open_rows = join_narrow(sampled.where("extra = 0 and size > 0").drop("rest"), reached, F.col("source").eqNullSafe(F.col("origin")))
    near = F.struct(F.abs(F.col("size") - F.col("missing")).alias("off"), "size", "h", "doc_id", "nr")
    closing = open_rows.groupBy("source", "missing").agg(F.min(near).alias("c")).where("c.off < missing")
    closing = materialise(closing.select(F.col("source").alias("origin"), F.col("c.h").alias("ch"), F.col("c.doc_id").alias("cid"), F.col("c.nr").alias("cnr")), "mix-closing")

    done = join_narrow(sampled.drop("rest"), closing, F.col("source").eqNullSafe(F.col("origin")), "left")
    is_closing = F.coalesce((F.col("extra") == 0) & (F.col("h") == F.col("ch")) & F.col("doc_id").eqNullSafe(F.col("cid")) & (F.col("nr") == F.col("cnr")), F.lit(False))
    done = done.select("doc_id", "source", "size", "h", F.when(is_closing, 1).otherwise(F.col("extra")).alias("extra"))
    out = join_narrow(done, plan, done["source"].eqNullSafe(plan["origin"]))
    copies = (F.col("whole") + F.col("extra")).cast("long")
    return out.select("doc_id", "size", "source", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), "h")


def mix(documents: DataFrame, weights: tuple[float, ...] = (5, 2, 1), limit: float = 3.0, seed: int = 0) -> DataFrame:
    """The rows of ``documents``, each repeated as often as the mix takes it.

    A null or blank text has size 0 and is not taken; a null source is a source of its own; rows without doc_id and repeated
    rows take part as any other. All columns come back, whatever their names.
    """
    taken = taken_copies(documents, weights, limit, seed).select(F.col("h").alias("mix_h"), F.col("doc_id").alias("mix_id"), F.col("source").alias("mix_source"), "copies")
    # Equal rows share a hash; their copies are counted together and dealt to them evenly.
    counts = materialise(taken.groupBy("mix_h", "mix_id", "mix_source").agg(F.sum("copies").alias("mix_copies"), F.count("*").alias("mix_rows")), "mix-copies")
    key = F.xxhash64(F.lit(seed), documents["doc_id"], documents["text"])
    named = documents.select(F.struct("*").alias("row"), key.alias("mix_key"), documents["doc_id"].alias("own_id"), documents["source"].alias("own_source"))
    same = (F.col("mix_key") == F.col("mix_h")) & F.col("own_id").eqNullSafe(F.col("mix_id")) & F.col("own_source").eqNullSafe(F.col("mix_source"))
    joined = join_narrow(named, counts, same)
    nth = F.row_number().over(Window.partitionBy("mix_h", "mix_id", "mix_source").orderBy("mix_h"))
    single = joined.where("mix_rows = 1").withColumn("mix_nth", F.lit(1))
    several = joined.where("mix_rows > 1").withColumn("mix_nth", nth)
    both = single.unionByName(several)
    own = F.floor(F.col("mix_copies") / F.col("mix_rows")) + (F.col("mix_nth") <= F.col("mix_copies") % F.col("mix_rows")).cast("int")
    repeated = both.withColumn("mix_again", F.explode(F.array_repeat(F.lit(0), own.cast("int"))))
    return repeated.select("row.*")
