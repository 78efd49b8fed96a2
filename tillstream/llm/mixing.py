"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in a fixed shuffled order, are cut into blocks. With weight w, block i (from
1) may not go out before slot floor((i - 1) / w) and must be out by slot ceil(i / w). One slot
sends one block: of those released, the one with the earliest deadline. So after any number of
slots every source has sent its weighted share to within less than one block.

Weights are whole parts of a period, and the schedule repeats after it. One period is worked out
as one SQL expression over the weights; every block then finds its slot by its number alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import ranked, stored

BLOCK_DOCS = 8
# Slots of a period: weights are rounded to this many parts.
PERIOD = 1_000
# Without given weights, a source's weight follows its number of documents to this power: large
# sources stay large, small ones are heard more often.
POWER = 0.7


def target_weights(docs: DataFrame, weights: dict[str, float] | None = None, period: int = PERIOD,
                   power: float = POWER) -> DataFrame:
    """(source, n_docs, parts): whole parts of the period by largest remainders, at least one each.

    Sources without a given weight, or a weight that isn't positive, have no parts; so do those
    that are given but have no documents, so their weight falls to the others. With more sources
    than slots, the period is as long as there are sources.
    """
    sources = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
    if weights is None:
        wanted = sources.withColumn("w", F.pow("n_docs", F.lit(power)))
    else:
        given = {k or "": float(v) for k, v in weights.items() if v > 0}
        table = F.create_map(*[F.lit(x) for kv in given.items() for x in kv]) if given else F.lit(None).cast("map<string,double>")
        wanted = sources.withColumn("w", F.try_element_at(table, F.col("source")))
    # One row holds all sources with a weight; a schedule over them is bounded by their number.
    one = wanted.agg(F.array_sort(F.collect_list(F.when(F.col("w") > 0, F.struct("source", "n_docs", "w")))).alias("all"))
    size = f"greatest({period}, size(all))"
    shares = one.selectExpr(f"""transform(all, x -> struct(x.source AS source, x.n_docs AS n_docs,
        ({size} - size(all)) * x.w / aggregate(all, 0D, (a, y) -> a + y.w) AS share)) AS all""")
    left = f"({size} - size(all) - CAST(aggregate(all, 0D, (a, y) -> a + floor(y.share)) AS INT))"
    return shares.selectExpr(f"""inline(transform(array_sort(transform(all, x -> struct(
        floor(x.share) - x.share AS less, x.source AS source, x.n_docs AS n_docs, floor(x.share) AS whole))),
        (x, i) -> struct(x.source AS source, x.n_docs AS n_docs,
        CAST(1 + x.whole + IF(i < {left}, 1, 0) AS BIGINT) AS parts)))""")


def schedule(weights: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(source, parts, period, horizon, nth, release, deadline, slot) of each block of one period.

    horizon is the first slot at which a source may have no block left (its last may not be full).
    """
    one = weights.agg(F.array_sort(F.collect_list(F.struct("source", "parts", "n_docs"))).alias("all"),
                      F.sum("parts").alias("period"))
    # State: the number of the next block of each source, and the picks so far.
    step = """transform(array(array_min(transform(s.next, (n, j) -> IF(
            floor((n - 1) * period / all[j].parts) <= t,
            struct(CAST(ceil(n * period / all[j].parts) AS BIGINT) AS deadline, j AS j), NULL)))), m -> struct(
        transform(s.next, (n, j) -> IF(j = m.j, n + 1, n)) AS next,
        concat(s.picks, array(struct(t AS slot, m.j AS j, s.next[m.j] AS nth))) AS picks))[0]"""
    picked = one.where("period > 0").selectExpr(
        "all", "period",
        f"array_min(transform(all, x -> CAST(floor(ceil(x.n_docs / {block_docs}) * period / x.parts) AS BIGINT))) AS horizon",
        f"""aggregate(sequence(0L, period - 1),
        struct(transform(all, x -> 1L) AS next, CAST(array() AS ARRAY<STRUCT<slot: BIGINT, j: INT, nth: BIGINT>>) AS picks),
        (s, t) -> {step}).picks AS picks""")
    return (picked.selectExpr("all", "period", "horizon", "inline(picks)")
            .selectExpr("all[j].source AS source", "all[j].parts AS parts", "period", "horizon", "nth",
                        "CAST(floor((nth - 1) * period / all[j].parts) AS BIGINT) AS release",
                        "CAST(ceil(nth * period / all[j].parts) AS BIGINT) AS deadline", "slot"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block_docs: int = BLOCK_DOCS,
        period: int = PERIOD) -> DataFrame:
    """The documents with block, release, deadline, slot, place and in_mix.

    (slot, place) is the order of the mix. in_mix marks the documents sent before the slot at which
    some source may have no block left; up to there the shares are the targets. The rest of each
    source is in later slots, so no row is lost. Reads doc_id and source; all other columns
    pass through, except that the added ones replace columns of the same name.

    A null source is the same as the empty one. A source without weight has null places and isn't
    in the mix. A null doc_id is a document like any other, repeated rows each have a place, and an
    empty table gives no rows.
    """
    added = ["block", "release", "deadline", "slot", "place", "in_mix"]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in added])
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    parts = stored(target_weights(docs.select(source.alias("source")), weights, period), "parts")
    slots = stored(schedule(parts, block_docs).coalesce(1), "slots")  # a row for each slot of a period
    keyed = (docs.select(source.alias("source"), F.col("doc_id"), row.alias("_doc"))
             .withColumn("turn", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
             .withColumn("bucket", F.substring("turn", 1, 3)))
    placed = ranked(keyed, ["source"], "bucket", ["turn", "doc_id"], "rank")
    cycle = F.coalesce(F.col("parts"), F.lit(1))
    numbered = (placed.join(parts.select("source", "parts"), "source", "left")
                .withColumn("block", F.floor(F.col("rank") / block_docs))
                .withColumn("nth", F.col("block") % cycle + 1).withColumn("turns", F.floor(F.col("block") / cycle)))
    later = F.col("turns") * F.col("period")
    joined = numbered.drop("parts").join(slots.drop("parts"), ["source", "nth"], "left")
    return joined.select("_doc.*", "block", (F.col("release") + later).alias("release"),
                         (F.col("deadline") + later).alias("deadline"), (F.col("slot") + later).alias("slot"),
                         F.when(F.col("slot").isNotNull(), F.col("rank") % block_docs).alias("place"),
                         F.coalesce(F.col("slot") + later < F.col("horizon"), F.lit(False)).alias("in_mix"))
