"""Mixing sources to target weights by Pareto order sampling (operator 8).

Every source gets a target, a number of words.  The targets share ``share``
times the size of all documents by the sources' weights and stop at
``most`` times a source's own size; the excess is shared again by weight until
no target is above its limit.  A document of a source whose target is m times
its size is first taken floor(m) times whole; what is left of the target is a
sample of fixed size: documents are ranked by random odds over inclusion odds,
[u / (1 - u)] / [p / (1 - p)], and taken in that order until their words come
nearest to the rest of the target.  Inclusion probabilities differ: p is the
rest of the target times the document's weight over the sum of weight times
size in its source, so the expected words are the rest.  The weight is the
number of binary digits of the size (longer documents are likelier) or a
column of the caller's; a probability of 1 or more makes the copy certain
(first in order).

Everything is DataFrame functions.  No window runs over all documents of a
source: ranks are first summed up in ``BINS`` bins a source, the windows run
over those sums, and only the documents of the one bin in which a source's
sample ends are ordered (about one in ``BINS`` of the source).

Defined results: a null text has size 0; null sources are a source of their
own, last in order; a source of size 0 has target 0; repeated rows count as
often as they occur; ties in rank go by document number, then by size; an
empty table gives an empty result.  Input columns other than the named ones
are passed through ``mix_copies`` and ignored by ``mix_sources``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import save

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
BINS = 1024


def word_count(text: Column) -> Column:
    """Number of words: runs of anything but ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: Column, seed: str) -> Column:
    """A number between 0 and 1 (both excluded) from 52 bits of md5 of the key."""
    text = F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=(3, 2), most: int = 2) -> DataFrame:
    """source, source_size, weight, target of each source; ``share`` is a fraction.

    The limit of each source over its weight orders the sources; the first k
    of them stop at their limit, the smallest k for which the others, sharing
    the rest by weight, stay below theirs.  One row a source, so the windows
    run over as many rows as there are sources.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    n = len(weights)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (place % n + 1).cast("int"))
    w = per.withColumn("weight", pick.cast("long"))
    up = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    below = up.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    zero = F.lit(0).cast("long")
    w = (w.withColumn("all_size", F.sum("source_size").over(whole))
         .withColumn("all_weight", F.sum("weight").over(whole))
         .withColumn("lower_size", F.coalesce(F.sum("source_size").over(below), zero))
         .withColumn("lower_weight", F.coalesce(F.sum("weight").over(below), zero)))
    # with all before it at their limit, this one's share is above its limit too
    rest = F.lit(share[0]) * F.col("all_size") - F.lit(share[1] * most) * F.col("lower_size")
    above = (F.col("weight") * rest
             >= F.lit(share[1] * most) * F.col("source_size")
             * (F.col("all_weight") - F.col("lower_weight")))
    w = w.withColumn("above", above)
    full_size = F.coalesce(F.sum(F.when(F.col("above"), F.col("source_size"))).over(whole), zero)
    full_weight = F.coalesce(F.sum(F.when(F.col("above"), F.col("weight"))).over(whole), zero)
    top = F.col("weight") * (F.lit(share[0]) * F.col("all_size") - F.lit(share[1] * most) * full_size)
    low = F.lit(share[1]) * (F.col("all_weight") - full_weight)
    target = (F.when(F.col("above"), (F.lit(most) * F.col("source_size")).cast("double"))
              .otherwise(top.cast("double") / low.cast("double")))
    return w.select("source", "source_size", "weight", target.alias("target"))


def mix_sources(docs: DataFrame, weights=WEIGHTS, share=(3, 2), most: int = 2,
                seed: str = "mix:", weight: Column | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document, and its copies.

    ``weight``: a positive whole number a document, in proportion to which its
    inclusion probability differs from others of its source (default: the
    binary digits of its size).
    """
    base = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                       *([] if weight is None else [weight.cast("long").alias("draw")]))
    if weight is None:
        base = base.withColumn("draw", F.length(F.bin("size")).cast("long"))
    sized = save(base, "mix-sizes")  # the texts are read once
    targets = source_targets(sized, weights, share, most)
    drawn = sized.groupBy(F.col("source").alias("d_source")).agg(F.sum(F.col("draw") * F.col("size")).alias("drawn"))
    # written, a row a source: Spark sizes a join as the product of its sides, and would broadcast the documents instead
    t = save(targets.join(drawn, targets["source"].eqNullSafe(drawn["d_source"]))
             .select(F.col("source").alias("t_source"), "source_size", "target", "drawn"), "mix-targets")
    copies = F.col("target") / F.col("source_size")
    whole = F.when(F.col("source_size") > 0, F.floor(copies)).otherwise(F.lit(0)).cast("long")
    u = uniform(F.col("doc_id"), seed)
    left = F.col("target") - (F.col("whole") * F.col("source_size")).cast("double")
    p = left * F.col("draw").cast("double") / F.col("drawn").cast("double")
    p = F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-12), p))
    rank = (u / (1 - u)) / (p / (1 - p))
    cell = F.least(F.lit(BINS - 1), F.floor(F.col("rank") / (1 + F.col("rank")) * BINS)).cast("int")
    ranked = (sized.join(t, sized["source"].eqNullSafe(t["t_source"])).drop("t_source")
              .withColumn("whole", whole)
              .withColumn("left", left)
              .withColumn("rank", F.when(F.col("drawn") > 0, rank).otherwise(F.lit(0.0)))
              .withColumn("bin", cell))
    sums = ranked.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"),
                                               F.first("left").alias("left"))
    run = Window.partitionBy("source").orderBy("bin")
    sums = (sums.withColumn("upto", F.sum("bin_size").over(run))
            .withColumn("before", F.col("upto") - F.col("bin_size"))
            .select(F.col("source").alias("b_source"), F.col("bin").alias("b_bin"), "upto", "before",
                    F.col("left").alias("b_left")))
    bins = save(sums, "mix-bins")
    # the bin in which a source's sample ends: at most one a source
    ends = (bins.filter((F.col("before") < F.col("b_left")) & (F.col("upto") >= F.col("b_left")))
            .select("b_source", F.col("b_bin").alias("end_bin"), "before"))
    got = (ranked.join(ends, ranked["source"].eqNullSafe(ends["b_source"]), "left").drop("b_source"))
    plain = got.filter(F.col("end_bin").isNull() | (F.col("bin") != F.col("end_bin")))
    # without an end the source's rest is 0 (nothing more) or beyond its last word (all)
    plain = plain.withColumn("once", F.when(F.col("end_bin").isNull(), F.col("left") > 0)
                             .otherwise(F.col("bin") < F.col("end_bin")))
    order = Window.partitionBy("source").orderBy("rank", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    last = (got.filter(F.col("bin") == F.col("end_bin"))
            .withColumn("sum", F.col("before") + F.sum("size").over(order))
            # the document in which the target falls is taken if that comes nearer
            .withColumn("once", F.when(F.col("sum") <= F.col("left"), F.lit(True)).otherwise(
                (F.col("sum") - F.col("size") < F.col("left"))
                & (F.col("sum") - F.col("left") < F.col("left") - (F.col("sum") - F.col("size")))))
            .drop("sum"))
    n = F.col("whole") + F.when(F.col("once"), 1).otherwise(0)
    return (plain.unionByName(last)
            .select("doc_id", "source", "size", "source_size", "target", n.cast("long").alias("copies"),
                    (n * F.col("size")).cast("long").alias("taken")))


def mix_copies(docs: DataFrame, **how) -> DataFrame:
    """The mixed documents: every row of ``docs`` as often as the mix takes it.

    Rows with the same document number, source and size are alike to the mix;
    their copies are dealt out in any order.
    """
    mixed = save(mix_sources(docs, **how), "mix")
    size = word_count(F.col("text"))
    # alike rows differ by one copy at most, and only where their source's sample ends among them
    per = (mixed.groupBy("doc_id", "source", "size")
           .agg(F.min("copies").alias("m_least"), F.sum("copies").alias("m_sum"), F.count("*").alias("m_rows"))
           .select(F.col("doc_id").alias("m_id"), F.col("source").alias("m_source"), F.col("size").alias("m_size"),
                   "m_least", (F.col("m_sum") - F.col("m_least") * F.col("m_rows")).alias("m_more")))
    per = save(per, "mix-copies")

    def joined(side: DataFrame) -> DataFrame:
        return docs.join(side, F.col("doc_id").eqNullSafe(F.col("m_id"))
                         & F.col("source").eqNullSafe(F.col("m_source")) & (size == F.col("m_size")))

    # a row a document, a few bytes in its file and dozens on the driver: never broadcast
    single = joined(per.filter("m_more = 0").hint("merge")).withColumn("n", F.col("m_least"))
    # at most one such group a source
    nth = Window.partitionBy("m_id", "m_source", "m_size").orderBy("text")
    more = (joined(F.broadcast(per.filter("m_more > 0"))).withColumn("k", F.row_number().over(nth))
            .withColumn("n", F.col("m_least") + F.when(F.col("k") <= F.col("m_more"), 1).otherwise(0)).drop("k"))
    rows = single.unionByName(more).filter(F.col("n") > 0)
    return (rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
            .select(*docs.columns))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS k
  FROM d GROUP BY source),
w AS (
  SELECT source, source_size, CASE k WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
         sum(source_size) OVER () AS all_size
  FROM s),
c AS (  -- a source is at its limit if, with all that reach theirs no later, its share is above it
  SELECT a.*, 
         a.weight * (3 * a.all_size - 4 * coalesce((SELECT sum(b.source_size) FROM w b
             WHERE b.source_size * a.weight < a.source_size * b.weight), 0))
         >= 4 * a.source_size * (SELECT sum(b.weight) FROM w b
             WHERE b.source_size * a.weight >= a.source_size * b.weight) AS above
  FROM w a),
t AS (
  SELECT source, source_size,
         CASE WHEN above THEN CAST(2 * source_size AS DOUBLE)
              ELSE CAST(CAST(weight * (3 * all_size - 4 * coalesce(sum(CASE WHEN above THEN source_size END) OVER (), 0)) AS BIGINT) AS DOUBLE)
                   / CAST(CAST(2 * sum(CASE WHEN above THEN 0 ELSE weight END) OVER () AS BIGINT) AS DOUBLE) END AS target
  FROM c),
r AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, length(bin(d.size)) AS draw,
         CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS whole,
         (CAST(CAST('0x' || substr(md5('mix:' || CAST(d.doc_id AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) + 0.5)
         / CAST(4503599627370496 AS DOUBLE) AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (
  SELECT *, target - CAST(whole * source_size AS DOUBLE) AS rest,
         CAST(CAST(sum(draw * size) OVER (PARTITION BY source) AS BIGINT) AS DOUBLE) AS drawn
  FROM r),
o AS (
  SELECT *, greatest(CAST(1e-12 AS DOUBLE), least(CAST(1 AS DOUBLE) - CAST(1e-12 AS DOUBLE),
                     rest * CAST(draw AS DOUBLE) / drawn)) AS p
  FROM p),
q AS (
  SELECT *, CAST(sum(size) OVER (PARTITION BY source
              ORDER BY CASE WHEN drawn > 0 THEN (u / (CAST(1 AS DOUBLE) - u)) / (p / (CAST(1 AS DOUBLE) - p))
                            ELSE CAST(0 AS DOUBLE) END, doc_id, size
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto
  FROM o)
SELECT doc_id, size, source_size, target,
       CAST((whole + CASE WHEN upto <= rest AND rest > 0 THEN 1
                          WHEN upto - size < rest AND upto - rest < rest - (upto - size) THEN 1
                          ELSE 0 END) * size AS BIGINT) AS taken
FROM q
"""

__all__ = ["BINS", "ORACLE_SQL", "WEIGHTS", "mix_copies", "mix_sources", "source_targets", "uniform", "word_count"]
