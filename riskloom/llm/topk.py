"""Exact top-k inner products by norm-bucketed retrieval (operator 5).

Vectors of whole numbers are sorted by length into buckets of ``BUCKET``,
longest first; some buckets make a group, the unit of work.  A query's k-th
best score in the first group is a lower bound of its k-th best score overall.
For each later bucket the bound, divided by the query's length and the
bucket's largest length, is a local threshold of the cosine:

* above 1, no vector of the bucket can reach the bound: it is left out;
* above ``COORDINATE``, the query's largest coordinates prune: a unit vector
  with that cosine must lie within a range of each coordinate;
* else the bucket's vectors are pruned by length: those shorter than the
  bound over the query's length are left out.

What is left is verified with whole-number products, and the bound rises with
every bucket.  Results are exact; ties go to the smaller number.

Queries travel in blocks of alike needs (bound over own length).  A block goes
only to the groups whose longest vector reaches the least need of the block;
a task holds one group and one block.

Defined results: vectors that are null, empty, hold a null or a non-finite
component, or have no number take no part; vectors of another dimension than
the query's are no candidates; rows that repeat a number and vector count
once, and other rows of the query's own number are no candidates; a query
with no candidate has no rows; further columns are ignored;
a vector of length 2**31.5 or more raises an error, as its products may not be
longs.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import parts, save

K, BUCKET, GROUP, BLOCK, COORDINATE = 5, 512, 16, 256, 0.7
NONE = -(1 << 63)  # no bound yet, or an empty place
COPIES = 64  # tasks that share the queries to the first group, each with its own copy of it


def whole_vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, v (floor of scale times each component, as long array), dim, length of usable rows."""
    x = F.col("embedding")
    ok = (x.isNotNull() & (F.size(x) > 0) & F.col("vec_id").isNotNull()
          & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))))
    v = F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))
    got = rows.filter(ok).select("vec_id", v.alias("v")).distinct()
    square = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    fits = F.when(square < F.lit(2.0 ** 63), square).otherwise(
        F.raise_error(F.lit("a vector is too long for products that are longs")).cast("double"))
    return got.select("vec_id", "v", F.size("v").alias("dim"), F.sqrt(fits).alias("length"))


def buckets(vectors: DataFrame, bucket: int = BUCKET, group: int = GROUP) -> DataFrame:
    """grp, seq, dim, longest, ids, data: buckets of vectors by length, longest first, as binary blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        held: dict[int, list] = {}
        n: dict[int, int] = {}

        def table(dim: int) -> pa.RecordBatch:
            ids, data = zip(*held.pop(dim))
            k = n.get(dim, 0)
            n[dim] = k + 1
            data = np.array(data, np.int64)
            longest = np.sqrt((data.astype(np.float64) ** 2).sum(1)).max()
            return pa.RecordBatch.from_arrays(
                [pa.array([(pid << 32) + (k // group)]), pa.array([k % group], pa.int32()), pa.array([dim], pa.int32()),
                 pa.array([float(longest)]), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                 pa.array([data.tobytes()], pa.binary())],
                names=["grp", "seq", "dim", "longest", "ids", "data"])

        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.setdefault(len(v), []).append((i, v))
                if len(held[len(v)]) == bucket:
                    yield table(len(v))
        for dim in list(held):
            yield table(dim)

    order = [F.col("dim"), F.col("length").desc(), F.col("vec_id")]
    return (vectors.repartitionByRange(parts(vectors), *order).sortWithinPartitions(*order)
            .select("vec_id", "v")
            .mapInArrow(run, "grp long, seq int, dim int, longest double, ids binary, data binary"))


def _best(scores, ids, k: int):
    """Places of the k best scores of each row, ties to the smaller id (ids ascend by place).

    Empty places hold ``NONE``: ``~`` turns the order of longs round without
    an overflow, so they come last.
    """
    import numpy as np
    n = scores.shape[1]
    if n <= k:
        return np.argsort(~scores, axis=1, kind="stable")
    kth = np.partition(scores, n - k, axis=1)[:, n - k]
    out = np.empty((len(scores), k), np.int64)
    for r in range(len(scores)):
        at = np.flatnonzero(scores[r] >= kth[r])
        out[r] = at[np.argsort(~scores[r, at], kind="stable")[:k]]
    return out


def _search(k: int):
    """Partition function: rows sorted by group and copy, buckets before query blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        none = NONE
        group, held = None, []
        for b in batches:
            for r in range(b.num_rows):
                cell = lambda c: b.column(c)[r].as_py()  # noqa: B023, E731
                if (cell("grp"), cell("copy")) != group:
                    group, held = (cell("grp"), cell("copy")), []
                dim = cell("dim")
                ids = np.frombuffer(cell("ids"), np.int64)
                whole = np.frombuffer(cell("data"), np.int64).reshape(len(ids), dim)
                if not cell("asks"):
                    order = np.argsort(ids, kind="stable")
                    ids, whole = ids[order], whole[order]
                    data = whole.astype(np.float64)
                    length = np.sqrt((data * data).sum(1))
                    held.append((ids, whole, data, length, data / np.maximum(length, 1e-300)[:, None]))
                    continue
                data = whole.astype(np.float64)
                bound = np.frombuffer(cell("bound"), np.int64)
                own = np.sqrt((data * data).sum(1))
                unit = data / np.maximum(own, 1e-300)[:, None]
                top_s = np.full((len(ids), k), none)
                top_i = np.full((len(ids), k), -1)
                low = bound.astype(np.float64)  # a score below it cannot be among the best
                low[bound == none] = -np.inf
                for c_ids, c_whole, c_data, c_len, c_unit in held:
                    longest = c_len.max()
                    with np.errstate(divide="ignore", invalid="ignore"):
                        local = np.where(own * longest > 0, low / (own * longest), np.where(low > 0, np.inf, -np.inf))
                    live = np.flatnonzero(local <= 1 + 1e-9)
                    if not len(live):
                        continue
                    mask = np.ones((len(live), len(c_ids)), bool)
                    pos = low[live] > 0
                    if pos.any():  # by length
                        need = low[live][pos] / np.maximum(own[live][pos], 1e-300)
                        mask[pos] &= c_len[None, :] >= need[:, None] * (1 - 1e-9)
                    for j in np.flatnonzero(local[live] > COORDINATE):  # by coordinates
                        q, t = unit[live[j]], min(1.0, local[live[j]] * (1 - 1e-9))
                        for f in np.argsort(-np.abs(q), kind="stable")[:4]:
                            half = np.sqrt(max(0.0, (1 - t * t) * (1 - q[f] * q[f])))
                            mask[j] &= np.abs(c_unit[:, f] - t * q[f]) <= half + 1e-9 if q[f] * q[f] <= t * t else \
                                (c_unit[:, f] * np.sign(q[f]) >= t * abs(q[f]) - half - 1e-9)
                    any_q, any_c = mask.any(1), mask.any(0)
                    if not any_q.any():
                        continue
                    live, at = live[any_q], np.flatnonzero(any_c)
                    if own[live].max() * longest < 1 << 53:  # doubles multiply such whole numbers exactly
                        score = (data[live] @ c_data[at].T).astype(np.int64)
                    else:
                        score = whole[live] @ c_whole[at].T
                    score[~mask[any_q][:, at] | (ids[live][:, None] == c_ids[at][None, :])] = none
                    s = np.concatenate([top_s[live], score], 1)
                    i = np.concatenate([top_i[live], np.broadcast_to(c_ids[at], score.shape)], 1)
                    order = np.argsort(i, axis=1, kind="stable")
                    s, i = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)
                    best = _best(s, i, k)
                    top_s[live], top_i[live] = np.take_along_axis(s, best, 1), np.take_along_axis(i, best, 1)
                    kth = top_s[live, k - 1].astype(np.float64)
                    kth[top_s[live, k - 1] == none] = -np.inf
                    low[live] = np.maximum(low[live], kth)
                q, j = np.nonzero(top_s > none)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[q]), pa.array(top_i[q, j]), pa.array(top_s[q, j])],
                    names=["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, bucket: int = BUCKET, group: int = GROUP) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best; both tables as of ``whole_vectors``."""
    stored = save(buckets(vectors, bucket, group), "topk-buckets")
    kind = "grp long, seq int, dim int, least double, ids binary, data binary, bound binary"

    def blocks(q: DataFrame) -> DataFrame:
        """Blocks of queries; ``least``: the least length that a candidate of any of them needs."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import numpy as np
            held: dict[int, list] = {}

            def table(dim: int) -> pa.RecordBatch:
                ids, data, low, need = zip(*held.pop(dim))
                return pa.RecordBatch.from_arrays(
                    [pa.array([None], pa.int64()), pa.array([None], pa.int32()), pa.array([dim], pa.int32()),
                     pa.array([min(need)], pa.float64()),
                     *[pa.array([np.array(x, np.int64).tobytes()], pa.binary()) for x in (ids, data, low)]],
                    names=["grp", "seq", "dim", "least", "ids", "data", "bound"])

            for b in batches:
                for i, v, low, need in zip(*(c.to_pylist() for c in b.columns)):
                    held.setdefault(len(v), []).append((i, v, NONE if low is None else low, need))
                    if len(held[len(v)]) == BLOCK:
                        yield table(len(v))
            for dim in list(held):
                yield table(dim)

        # a score above 0 needs a length; other bounds are reached by any vector
        need = F.when((F.col("bound") > 0) & (F.col("length") > 0), F.col("bound") / F.col("length")).otherwise(F.lit(0.0))
        q = q.withColumn("need", need * F.lit(1 - 1e-9))
        return (q.repartitionByRange(parts(vectors), "dim", "need", "vec_id").sortWithinPartitions("dim", "need")
                .select("vec_id", "v", "bound", "need").mapInArrow(run, kind))

    groups = save(stored.groupBy("grp", "dim").agg(F.max("longest").alias("longest")), "topk-groups")
    first = groups.groupBy("dim").agg(F.min("grp").alias("grp")).join(groups, ["grp", "dim"])

    def search(q: DataFrame, to: DataFrame, copies: int) -> DataFrame:
        cols = ["grp", "copy", "seq", "dim", "ids", "data", "bound"]
        own = to.select(F.col("dim").alias("d"), "grp", "longest")
        asked = (blocks(q).drop("grp").withColumn("copy", F.pmod(F.xxhash64("ids"), F.lit(copies)).cast("int"))
                 .join(own, (F.col("dim") == F.col("d")) & (F.col("longest") >= F.col("least"))))
        kept = (stored.join(to.select("grp", "dim"), ["grp", "dim"], "left_semi")
                .withColumn("bound", F.lit(None).cast("binary"))
                .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))))
        rows = (kept.select(*cols).withColumn("asks", F.lit(False))
                .unionByName(asked.select(*cols).withColumn("asks", F.lit(True))))
        return (rows.repartition(parts(vectors), "grp", "copy").sortWithinPartitions("grp", "copy", "asks", "seq")
                .mapInArrow(_search(k), "query_id long, vec_id long, score long"))

    seeds = save(search(queries.withColumn("bound", F.lit(None).cast("long")), first,
                        min(COPIES, parts(vectors))), "topk-first")
    low = (seeds.groupBy("query_id").agg(F.min("score").alias("bound"), F.count("*").alias("n"))
           .select(F.col("query_id").alias("vec_id"), F.when(F.col("n") >= k, F.col("bound")).alias("bound")))
    asks = queries.join(low, "vec_id", "left")
    rest = groups.join(first, ["dim", "grp"], "left_anti")
    found = seeds.unionByName(search(asks, rest, 1))
    by = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


ORACLE_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

__all__ = ["K", "ORACLE_SQL", "top_k", "whole_vectors"]
