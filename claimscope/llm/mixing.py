"""Mixing sources to target weights by Pareto order sampling.

Every document has an expected number of copies.  Its whole part is taken for
certain; the rest is an inclusion probability ``p``.  Documents of a source
are ranked by random odds over inclusion odds, ``u/(1-u) / (p/(1-p))``, and
the first ones are taken until the sizes taken reach the expected size: a
sample of fixed size with unequal probabilities.

The rank is never sorted as a whole.  Sizes are summed over bins of the rank
(combined before the shuffle), the bin where the target falls is ordered, and
one cutoff a source comes out; each document then decides by itself.

``u`` is a digest of ``doc_id`` and the seed, so reruns agree.  Defined cases:
null text has size 0; null source is a source, last in order; a null
``doc_id`` draws by its text's digest; rows that tie in rank and ``doc_id``
share one decision; an empty table gives an empty mix.  Other columns are
kept by ``mixed`` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimscope.llm.shared import stored

#: Copies that a document gets at most.
MAX_COPIES = 3
#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
SEED = "mix"
BINS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(seed: str) -> Column:
    """A number in (0, 1) for each document, from 52 bits of a digest."""
    name = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(2**52)


def odds_rank(u: Column, p: Column) -> Column:
    return F.try_divide(u / (1 - u), p / (1 - p))  # null where p is 0


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_COPIES) -> DataFrame:
    """(source, size) -> (source, source_size, target), a row for each source.

    The sum of all sizes is shared by weight; a target stops at ``most`` times
    its source's size and the excess is shared among the others by weight,
    which ends at one level: target = min(most * size, level * weight).
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").cast("double").alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = by_source.withColumn("weight", F.element_at(F.lit(list(weights)), ((F.row_number().over(named) - 1) % len(weights) + 1).cast("int")).cast("double"))
    ranked = ranked.withColumn("cap", F.col("source_size") * most)
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    onward = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    ranked = ranked.withColumn("share", (F.sum("source_size").over(everything) - before) / onward)
    # filled in this order, the shares rise until the first source that stays below its cap
    ranked = ranked.withColumn("level", F.max("share").over(everything))
    target = F.least("cap", F.col("level") * F.col("weight"))
    return ranked.select("source", F.col("source_size").cast("long").alias("source_size"), target.alias("target"))


def pareto_cutoffs(rows: DataFrame) -> DataFrame:
    """(source, doc_id, size, u, p) -> (source, cut_rank, cut_id): the last
    document that is taken; a source that takes none has no row."""
    ranked = rows.where("p > 0 and size > 0").withColumn("rank", odds_rank(F.col("u"), F.col("p")))
    ranked = ranked.withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * BINS).cast("int"))
    bins = ranked.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"), F.sum((F.col("p") * F.col("size")).cast("decimal(38,6)")).alias("due"), F.max(F.struct("rank", "doc_id")).alias("last"))
    so_far = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("source")
    bins = bins.withColumn("end", F.sum("bin_size").over(so_far)).withColumn("due", F.sum("due").over(whole).cast("double"))
    bins = stored(bins.withColumn("begin", F.col("end") - F.col("bin_size")), "bins")

    full = bins.where("end <= due").select("source", "last")
    split = bins.where("begin < due and due < end").select(F.col("source").alias("at_source"), F.col("bin").alias("at_bin"), "begin", "due")
    inside = ranked.join(split, F.col("source").eqNullSafe(F.col("at_source")) & (F.col("bin") == F.col("at_bin")))
    upto = Window.partitionBy("source").orderBy(F.struct("rank", "doc_id")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("sum", F.col("begin") + F.sum("size").over(upto)).where("sum - size / 2 <= due")
    cut = full.unionByName(inside.select("source", F.struct("rank", "doc_id").alias("last"))).groupBy("source").agg(F.max("last").alias("last"))
    return cut.select("source", F.col("last.rank").alias("cut_rank"), F.col("last.doc_id").alias("cut_id"))


def mix_plan(docs: DataFrame, seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """(sizes, plan): a row for each document (source, doc_id, size, u), and a
    row for each source (source_size, target, rate, cut_rank, cut_id)."""
    sizes = docs.select("source", F.col("doc_id").cast("long").alias("doc_id"), word_count("text").alias("size"), uniform(seed).alias("u"))
    sizes = stored(sizes, "sizes")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = stored(source_targets(sizes).withColumn("rate", rate), "targets")
    named = targets.select(F.col("source").alias("named"), "rate")
    rows = sizes.join(named, F.col("source").eqNullSafe(F.col("named"))).withColumn("p", F.col("rate") - F.floor("rate"))
    cuts = stored(pareto_cutoffs(rows), "cuts").withColumnRenamed("source", "cut_source")
    plan = targets.join(cuts, F.col("source").eqNullSafe(F.col("cut_source")), "left").drop("cut_source")
    return sizes, stored(plan, "plan")


def _copies(u: Column, doc_id: Column) -> Column:
    p = F.col("__rate") - F.floor("__rate")
    rank = odds_rank(u, p)
    taken = (rank < F.col("__cut_rank")) | ((rank == F.col("__cut_rank")) & (F.struct(doc_id.alias("d")) <= F.struct(F.col("__cut_id").alias("d"))))
    return (F.floor("__rate") + F.when((p > 0) & taken, 1).otherwise(0)).cast("int")


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    plan = plan.select(*(F.col(c).alias(f"__{c}") for c in plan.columns))
    return rows.join(plan, F.col("source").eqNullSafe(F.col("__source")))


def mix_report(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, size, source, copies, source_size, target, taken of every row."""
    sizes, plan = mix_plan(docs, seed)
    rows = _with_plan(sizes, plan).withColumn("copies", _copies(F.col("u"), F.col("doc_id")))
    return rows.select("doc_id", "size", "source", "copies", F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mix: every row of ``docs`` as many times as it is taken."""
    _, plan = mix_plan(docs, seed)
    rows = _with_plan(docs, plan)
    rows = rows.withColumn("__times", _copies(uniform(seed), F.col("doc_id").cast("long"))).where("__times > 0")
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*(F.col(f"`{c}`") for c in docs.columns))


ORACLE = r"""
WITH sizes AS (
  SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
per_source AS (
  SELECT source, sum(size)::DOUBLE AS source_size, (((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1)::DOUBLE AS weight
  FROM sizes GROUP BY source),
shares AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM per_source),
levels AS (SELECT *, max(share) OVER () AS level FROM shares),
targets AS (SELECT source, source_size, least(3 * source_size, level * weight) AS target FROM levels),
rated AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets),
ranked AS (
  SELECT s.*, r.source_size, r.target, r.rate, r.rate - floor(r.rate) AS p,
    (s.u / (1 - s.u)) / ((r.rate - floor(r.rate)) / (1 - (r.rate - floor(r.rate)))) AS rank
  FROM sizes s JOIN rated r ON s.source IS NOT DISTINCT FROM r.source),
summed AS (
  SELECT *, sum(CASE WHEN p > 0 THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY rank, doc_id NULLS FIRST RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
    sum((p * size)::DECIMAL(38, 6)) OVER (PARTITION BY source)::DOUBLE AS due
  FROM ranked)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  (size * (floor(rate) + CASE WHEN p > 0 AND upto - size / 2.0 <= due THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed
"""
