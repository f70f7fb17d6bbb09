"""Mixing sources to target weights by repetition rates.

Words are summed per source, a target per source gives its rate (target / size), and each document
is emitted floor(rate) times plus once more when its hash-seeded coin falls under the fraction. Each
source tries a fixed number of seeds, and its coins are those of the seed whose taken words come
nearest to its target. So each seed's draw is Bernoulli, but the chosen one is not a plain draw: it
is the best of a fixed number, which keeps sources of few documents near their targets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, word_count

#: A source table of at most this many rows is broadcast; a larger one joins by shuffle.
BROADCAST_SOURCES = 2000


#: Seeds that each source tries.
SEEDS = 32


def coins(*cols: Column, seed: int) -> tuple[Column, Column]:
    """Two independent 48-bit numbers that depend on the values and the seed alone, from an MD5."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols], F.lit(str(seed))))
    number = lambda at: F.conv(F.substring(digest, at, 12), 16, 10).cast("long")
    return number(1), number(13)


def toss(first: Column, second: Column, k: Column | int) -> Column:
    """The coin of seed ``k``: a uniform number in [0, 1), by double hashing."""
    return F.pmod(first + (k if isinstance(k, Column) else F.lit(k)) * second, F.lit(1 << 48)).cast("double") / F.lit(float(1 << 48))


def _ranked(sources: DataFrame) -> DataFrame:
    """Rank sources by code point, null last, without one task that holds them all.

    The rows are dealt by range and written; a task's own row numbers plus the row counts of the
    ranges before it are global ranks. The window over counts has a row per partition.
    """
    parts = max(1, sources.sparkSession.sparkContext.defaultParallelism)
    order = [F.col("source").asc_nulls_last()]
    dealt = cut(sources.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    before = dealt.groupBy("part").agg(F.count("*").alias("n")).withColumn(
        "before", F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    )
    own = F.row_number().over(W.partitionBy("part").orderBy(*order)) - 1
    return dealt.withColumn("own", own).join(F.broadcast(before.select("part", "before")), "part").select(
        "source", "source_size", (F.col("own") + F.coalesce("before", F.lit(0))).alias("rank")
    )


def source_targets(sized: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Sources in code point order, null last as a source of its own, weigh ``weights`` repeating and
    share ``share`` times all sizes. A target stops at ``most`` times its source's size; the excess
    is shared again by weight among the rest until none is above. Only three sums a round reach
    the driver. Sources without words have target zero.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    values = F.array(*[F.lit(float(w)) for w in weights])
    ranked = _ranked(sources).withColumn("weight", F.element_at(values, (F.col("rank") % len(weights) + 1).cast("int")))
    ranked = cut(ranked.withColumn("most", F.col("source_size") * F.lit(float(most))))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    capped, level = -1, 0.0
    below = F.lit(True)
    while True:
        sums = ranked.agg(
            F.sum(F.when(below, 0.0).otherwise(F.col("most"))).alias("stopped"),
            F.sum(F.when(below, F.col("weight"))).alias("open"),
            F.count_if(~below).alias("n"),
        ).first()
        if not sums.open or sums.n == capped:
            break
        capped = sums.n
        level = max(0.0, share * total - (sums.stopped or 0.0)) / sums.open
        below = F.col("weight") * F.lit(level) < F.col("most")
    target = F.when(below, F.col("weight") * F.lit(level)).otherwise(F.col("most"))
    return ranked.select("source", "source_size", target.alias("target"))


def _small(table: DataFrame) -> DataFrame:
    """``table``, marked for a broadcast where it has at most ``BROADCAST_SOURCES`` rows."""
    return F.broadcast(table) if table.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES else table


def _rate() -> Column:
    return F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(F.lit(0.0))


def _with_seeds(targets: DataFrame, sized: DataFrame) -> DataFrame:
    """``targets`` with mix_seed: of ``SEEDS`` seeds, the one whose extra copies of the rows ``sized``
    (source, size, first, second) hold the words nearest to the fraction of all; the least on a tie.

    One pass of sums per source, added up before the shuffle.
    """
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("_mix_key"))).withColumn("part", _rate() - F.floor(_rate()))
    sums = [F.sum(F.when(toss(F.col("first"), F.col("second"), k) < F.col("part"), F.col("size")).otherwise(F.lit(0))).alias(f"s{k}") for k in range(SEEDS)]
    won = joined.groupBy("_mix_key", "mix_source_size", "mix_target").agg(F.first("part").alias("part"), *sums)
    off = F.array(*[F.abs(F.col(f"s{k}") - F.col("part") * F.col("mix_source_size")) for k in range(SEEDS)])
    return won.select("_mix_key", "mix_source_size", "mix_target", (F.array_position(off, F.array_min(off)) - 1).alias("mix_seed"))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 17,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """All rows of ``docs`` with mix_size, mix_source_size, mix_target, mix_copies added.

    mix_copies is floor(rate) plus a coin of the fraction's probability, seeded by the row's id and
    text and by the seed that its source took, so that reruns agree and equal rows fall alike. Null
    texts have size 0, a null source is a source; an empty table gives an empty table. Input columns
    of the added names are replaced. The source table is broadcast only up to ``BROADCAST_SOURCES``
    rows; beyond it the join is by shuffle, where adaptive execution splits a hot source.
    """
    docs = docs.drop("mix_size", "mix_source_size", "mix_target", "mix_copies", "mix_seed", "_mix_key")
    size = word_count(F.col(text_col))
    first, second = coins(F.col(id_col), F.col(text_col), seed=seed)
    sized = docs.select(F.col(source_col).alias("source"), size.alias("size"), first.alias("first"), second.alias("second"))
    targets = cut(source_targets(sized.select("source", "size"), weights, share, most)).select(
        F.col("source").alias("_mix_key"), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target")
    )
    targets = _small(cut(_with_seeds(_small(targets), sized)))
    extra = (toss(first, second, F.col("mix_seed")) < _rate() - F.floor(_rate())).cast("long")
    return (
        docs.withColumn("mix_size", size)
        .join(targets, F.col(source_col).eqNullSafe(F.col("_mix_key")))
        .withColumn("mix_copies", (F.floor(_rate()) + extra).cast("long"))
        .drop("_mix_key", "mix_seed")
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as many times as it is taken, with its own columns, whatever their names."""
    names = {k: options.pop(f"{k}_col", default) for k, default in (("id", "doc_id"), ("text", "text"), ("source", "source"))}
    packed = docs.select(F.struct("*").alias("row"), *[F.col(c).alias(k) for k, c in names.items()])
    taken = mix(packed, id_col="id", text_col="text", source_col="source", **options).where(F.col("mix_copies") > 0)
    return taken.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("mix_copies").cast("int")))).select("row.*")
