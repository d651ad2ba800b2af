"""Mixing sources to target weights by Sainte-Laguë apportionment.

The corpus is cut into equal-token blocks. Sources receive whole numbers of
blocks by highest quotients votes / (2 k + 1), the votes being their targets;
the shards of each source receive theirs in the same way from the source's
number. Within a shard, documents stand in a seeded order, and the blocks that
it was given are a seeded run of that order, gone through again from the start
as often as needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.llm.text import n_words
from quillon.session import materialise

#: Shards over the whole corpus, whatever its size; a source has its share of them.
SHARDS = 4096
#: Blocks over the whole corpus at most. Fewer where that would make them shorter than a word.
BLOCKS = 2**26
#: Bits of a document's place in the order of its shard, when documents are taken whole, and those of them that make its lane.
PLACE_BITS, LANE_BITS = 62, 12


def source_targets(sources: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """sources: (source, source_size), a row each. Adds idx, weight and target.

    Weights go to the sources by code point, null last, again and again. Targets
    share the sum of all sizes by weight; none exceeds cap times its source's
    size, and what is over goes to the others by weight until none is above.
    Filling sources by ascending cap / weight gives that in one pass.
    """
    one = Window.partitionBy()
    ranked = sources.withColumn("idx", F.row_number().over(one.orderBy(F.asc_nulls_last("source"))))
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("idx") - 1) % len(weights) + 1).cast("int")))
    limit = F.col("source_size") * F.lit(float(cap))
    by_level = one.orderBy(limit / F.col("weight"), "idx")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    filled = ranked.withColumn("total", F.sum("source_size").over(one)).withColumn(
        "level", (F.col("total") - F.coalesce(F.sum(limit).over(before), F.lit(0.0))) / F.sum("weight").over(after)
    )
    free = F.min(F.when(limit > F.col("level") * F.col("weight"), F.struct(limit / F.col("weight"), F.col("idx"), F.col("level")))).over(one)
    filled = filled.withColumn("final_level", free["level"])
    target = F.when(F.col("final_level").isNull(), limit).otherwise(F.least(limit, F.col("final_level") * F.col("weight")))
    return filled.select("source", "idx", "weight", "source_size", "total", target.cast("double").alias("target"))


def sainte_lague(parties: DataFrame, group: Sequence[str], party: str, votes: str, seats: str, out: str) -> DataFrame:
    """Adds out: the seats that each party gets of its group's seats, by highest quotients.

    With P parties and s seats, the divisor that gives s seats lies within a
    share P / 2s of votes / s. So each party surely has the seats below that
    range, and only the quotients inside it are ranked: about two for a party,
    however many seats there are. Ties go to the smaller party number. Rows must
    be few (sources or shards): the windows of a group run in one task.
    """
    g = Window.partitionBy(*group)
    v, s = F.col(votes).cast("double"), F.col(seats).cast("double")
    total = F.sum(v).over(g)
    quota = F.when(total > 0, s * v / total).otherwise(0.0)
    slack = F.when(s > 0, F.sum(F.when(v > 0, 1).otherwise(0)).over(g) / (2 * s)).otherwise(0.0)
    sure = F.greatest(F.lit(0), F.floor(quota * (1 - slack) + 0.5).cast("long") - 1)
    most = F.floor(quota * (1 + slack) + 0.5).cast("long") + 1
    p = parties.withColumns({"_sure": F.when(v > 0, sure).otherwise(F.lit(0)).cast("long"), "_most": F.when((v > 0) & (s > 0), most).otherwise(F.lit(0)).cast("long")})
    p = p.withColumn("_left", F.col(seats).cast("long") - F.sum("_sure").over(g))
    next_seats = F.when(F.col("_most") > F.col("_sure"), F.sequence("_sure", F.col("_most") - 1)).otherwise(F.array().cast("array<bigint>"))
    quotients = p.withColumn("_k", F.explode_outer(next_seats)).withColumn("_q", v / (2 * F.col("_k") + 1))
    ranked = quotients.withColumn("_rank", F.row_number().over(g.orderBy(F.desc_nulls_last("_q"), party, "_k")))
    won = F.col("_k").isNotNull() & (F.col("_rank") <= F.col("_left"))
    keys = [*group, party]
    columns = [c for c in parties.columns if c not in keys]
    return ranked.groupBy(*keys).agg(*[F.first(c).alias(c) for c in columns], (F.first("_sure") + F.sum(won.cast("long"))).alias(out))


def _hash(seed: int, *columns: Column | str) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def _source_quotas(sums: DataFrame, weights: Sequence[float], cap: float, blocks: int) -> DataFrame:
    """sums: (source, source_size). Adds the columns of source_targets(), block (words of one) and quota (blocks of the source)."""
    sources = source_targets(sums, weights, cap)
    sources = sources.withColumn("block", F.greatest(F.lit(1), F.ceil(F.col("total") / blocks)).cast("long"))
    sources = sources.withColumn("seats", F.ceil(F.col("total") / F.col("block")).cast("long"))
    return sainte_lague(sources, [], "idx", "target", "seats", "quota")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    cap: float = 3.0,
    seed: int = 17,
    shards: int = SHARDS,
    blocks: int = BLOCKS,
) -> DataFrame:
    """How many words of each document the mix takes.

    docs needs doc_id, source and text; other columns are ignored. Returns a row
    for each row of docs: doc_id, source, size, source_size, target (its
    source's), taken. No document gives more than cap times its size.

    A null text has size 0, a null source is a source of its own, the last. An
    empty table gives no rows. Rows with the same doc_id, source and size are
    one unit and get the same taken. A document longer than a block is cut: the
    mix may take part of it.
    """
    counted = docs.select(F.col("doc_id"), F.col("source"), n_words(F.col("text")).alias("size"))
    units = materialise(counted.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows")))

    sums = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    sources = _source_quotas(sums, weights, cap, blocks)
    sources = sources.withColumn("shards", F.when(F.col("total") > 0, F.greatest(F.lit(1), F.ceil(F.lit(shards) * F.col("source_size") / F.col("total")))).otherwise(1).cast("long"))
    sources = materialise(sources.select("source", "idx", "source_size", "target", "block", "quota", "shards"), 1)

    s = sources.withColumnRenamed("source", "_source")
    placed = units.join(s, units["source"].eqNullSafe(s["_source"])).drop("_source")
    placed = placed.withColumns({"shard": F.pmod(_hash(seed, "doc_id", "size"), "shards"), "words": F.col("size") * F.col("rows")})

    by_shard = placed.groupBy("idx", "shard").agg(F.sum("words").alias("shard_size"), F.first("quota").alias("source_quota"), F.first("block").alias("block"))
    by_shard = sainte_lague(by_shard, ["idx"], "shard", "shard_size", "source_quota", "quota")
    given = F.least(F.col("quota") * F.col("block"), (F.col("shard_size") * cap).cast("long"))
    by_shard = by_shard.withColumn("given", given)
    size = F.greatest(F.col("shard_size"), F.lit(1))
    passes = F.floor(F.col("given") / size).cast("long")
    by_shard = by_shard.withColumns({"passes": passes, "rest": F.col("given") - passes * size})
    at = F.pmod(_hash(seed + 1, "idx", "shard"), F.ceil(size / F.col("block")).cast("long")) * F.col("block")
    by_shard = materialise(by_shard.select("idx", "shard", "shard_size", "passes", "rest", at.alias("at")))

    w = Window.partitionBy("idx", "shard").orderBy(_hash(seed + 2, "doc_id", "size"), "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    laid = placed.join(by_shard, ["idx", "shard"]).withColumn("_end", F.sum("words").over(w))
    start, end = F.col("_end") - F.col("words"), F.col("_end")

    def within(lo: Column, hi: Column) -> Column:
        return F.greatest(F.lit(0), F.least(end, hi) - F.greatest(start, lo))

    stop = F.col("at") + F.col("rest")
    run = within(F.col("at"), F.least(stop, F.col("shard_size"))) + within(F.lit(0), stop - F.col("shard_size"))
    taken = F.col("passes") * F.col("size") + F.floor(run / F.col("rows")).cast("long")
    laid = laid.withColumn("taken", F.when(F.col("size") == 0, F.lit(0)).otherwise(taken).cast("long"))
    one_each = laid.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return one_each.select("doc_id", "source", F.col("size").cast("long"), F.col("source_size").cast("long"), F.col("target").cast("double"), "taken")


def _placed(size: Column, doc_id: Column, seed: int) -> dict[str, Column]:
    """_shard (a size class by powers of two) and _at (a seeded place in its order, 62 bits) of a document with words."""
    shard = F.floor(F.log2(F.greatest(size, F.lit(1)))).cast("int")
    return {"_shard": shard, "_at": F.shiftrightunsigned(_hash(seed + 2, doc_id, size), 64 - PLACE_BITS)}


def _cuts(docs: DataFrame, weights: Sequence[float], cap: float, seed: int, blocks: int) -> DataFrame:
    """(_source, _class, _passes, _cut): documents of a shard are taken _passes times, and once more up to place _cut.

    A shard is a source's documents of one size class. Its blocks are the first of
    its seeded order; the document in which they end is taken if most of it lies
    within. So a source misses its target by half a document of each class at
    most, by less than its longest in all. The order is summed up by lanes, and
    only the lanes in which a shard's blocks end are gone through by document.
    """
    sized = docs.select("source", "doc_id", n_words(F.col("text")).alias("_size")).withColumns(_placed(F.col("_size"), F.col("doc_id"), seed))
    slim = materialise(sized.select("source", "_size", "_shard", "_at", F.shiftright("_at", PLACE_BITS - LANE_BITS).alias("_lane")))
    sources = _source_quotas(slim.groupBy("source").agg(F.sum("_size").alias("source_size")), weights, cap, blocks)
    sources = materialise(sources.select(F.col("source").alias("_source"), "idx", "block", F.col("quota").alias("source_quota")), 1)
    lanes = slim.where("_size > 0").groupBy("source", "_shard", "_lane").agg(F.sum("_size").alias("words"))
    lanes = materialise(lanes.join(sources, F.col("source").eqNullSafe(F.col("_source"))).drop("source"))
    shards = lanes.groupBy("idx", "_shard").agg(F.sum("words").alias("shard_size"), F.first("source_quota").alias("source_quota"), F.first("block").alias("block"))
    shards = sainte_lague(shards, ["idx"], "_shard", "shard_size", "source_quota", "quota")
    given = F.least(F.col("quota") * F.col("block"), (F.col("shard_size") * cap).cast("long"))
    shards = shards.withColumn("_passes", F.floor(given / F.col("shard_size")).cast("int")).withColumn("_rest", given - F.col("_passes") * F.col("shard_size"))
    shards = materialise(shards.select("idx", "_shard", "_passes", "_rest"), 1)

    before = Window.partitionBy("idx", "_shard").orderBy("_lane").rowsBetween(Window.unboundedPreceding, -1)
    ends = lanes.withColumn("_before", F.coalesce(F.sum("words").over(before), F.lit(0))).join(shards, ["idx", "_shard"])
    ends = ends.where("_before < _rest AND _rest <= _before + words")
    ends = materialise(ends.select("idx", "_source", F.col("_shard").alias("_s"), F.col("_lane").alias("_l"), (F.col("_rest") - F.col("_before")).alias("_left")))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("_shard") == F.col("_s")) & (F.col("_lane") == F.col("_l"))
    units = slim.where("_size > 0").join(ends, same).groupBy("idx", "_shard", "_lane", "_left", "_at").agg(F.sum("_size").alias("words"))
    until = Window.partitionBy("idx", "_shard").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    within = F.sum("words").over(until) - F.col("words") / 2 <= F.col("_left")
    last = units.withColumn("_in", within).groupBy("idx", "_shard").agg(F.max(F.when(F.col("_in"), F.col("_at"))).alias("_last"), F.first("_lane").alias("_lane"))
    cut = last.select("idx", "_shard", F.coalesce("_last", F.shiftleft(F.col("_lane").cast("long"), PLACE_BITS - LANE_BITS) - 1).alias("_cut"))
    every = shards.join(cut, ["idx", "_shard"], "left").join(sources.select("idx", "_source"), "idx")
    return materialise(every.select("_source", F.col("_shard").alias("_class"), "_passes", F.coalesce("_cut", F.lit(-1)).alias("_cut")), 1)


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: float = 3.0, seed: int = 17, blocks: int = BLOCKS) -> DataFrame:
    """The documents of the mix: each row of docs as often as the mix takes it whole. Columns are those of docs.

    Targets and quotas are those of mix(); shards are a source's size classes, so
    that a small table of cuts tells every document from its own hash how often
    it is taken, wherever it lies: texts aren't moved and no plan grows with the
    documents. Rows that repeat a doc_id, source and size are taken alike.
    Documents without words are taken nowhere; a null source is a source of its
    own, a null doc_id an id like others. An empty table gives no rows.
    """
    cuts = _cuts(docs, weights, cap, seed, blocks)
    sized = docs.select(F.struct("*").alias("_row"), n_words(F.col("text")).alias("_size")).where("_size > 0")
    sized = sized.withColumns(_placed(F.col("_size"), F.col("_row.doc_id"), seed))
    found = sized.join(cuts, F.col("_row.source").eqNullSafe(F.col("_source")) & (F.col("_shard") == F.col("_class")))
    copies = F.col("_passes") + (F.col("_at") <= F.col("_cut")).cast("int")
    repeated = found.withColumn("_copies", copies).where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return repeated.select("_row.*")
