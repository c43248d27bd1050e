"""Ranked lexical search with hashed max-sketches (operator 12).

A document's sketch is a hash table without collision handling: as many bytes
as ``ROOM`` times its distinct terms, rounded up to a power of two.  Each term
frequency goes to the byte of the term's CRC-32, and a byte keeps the largest.
Within one document the impact of a term grows with its frequency, so the
maxima of frequencies are the maxima of impacts, whatever the statistics of
the corpus are (255 stands for any higher frequency).

A batch of items looks all its terms up in every sketch.  The impacts found
there are at least the true ones, so their weighted sum bounds the score from
above.  The documents of the highest bounds are scored exactly first; their
k-th score is the threshold from which every task starts.  A task then takes,
for each item, its documents by descending bound and scores them exactly until
the bound falls below the threshold, which rises with the k-th score found.
A skipped document has a bound, and so a score, below that of k others.

Items are read in batches of at most ``TERMS`` distinct terms (an item of more
is a batch of its own), so neither the driver nor a task holds all items.

Defined results: a null text has no terms; documents without terms take no
part; repeated documents count and rank as often as they occur; items that
repeat number and text count once, different texts under one number are ranked
each on its own; an item without terms or without a document of a score above
0 has no rows; null document numbers rank behind all others of equal score;
further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from math import floor, log
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import save
from .licences import words

K, ROOM, TERMS = 20, 8, 50_000
SLICE = 1 << 19  # cells of the table of bounds that a task holds at a time
UNIT = 1_000_000_000
MOST = 1_000_000  # no impact is higher


def sketch(count: Counter, room: int = ROOM) -> bytes:
    """Largest frequency (255: that or more) of the terms that share a place."""
    import numpy as np
    size = 1 << max(3, (room * len(count) - 1).bit_length())
    out = np.zeros(size, np.uint8)
    at = np.fromiter(map(crc32, count), np.int64, len(count)) & (size - 1)
    tf = np.minimum(np.fromiter(count.values(), np.int64, len(count)), 255)
    np.maximum.at(out, at, tf.astype(np.uint8))
    return out.tobytes()


def index(docs: DataFrame, room: int = ROOM) -> DataFrame:
    """doc_id, text, n (terms) and sketch of every document that has a term."""
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                t = t.as_py()
                w = words(t)
                if w:
                    rows.append((i, t, len(w), sketch(Counter(w), room)))
            cols = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], to_arrow_type(kind)), pa.array(cols[1], pa.string()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.binary())], names=["doc_id", "text", "n", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind.simpleString()}, text string, n long, sketch binary")


def frequencies(stored: DataFrame, vocabulary: list[bytes]) -> dict[bytes, int]:
    """Documents that hold each term of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count = set(vocabulary), Counter()
        for b in batches:
            for t in b.column(0):
                count.update(known.intersection(words(t.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.binary()), pa.array(list(count.values()), pa.int64())],
                                         names=["term", "n"])

    got = (stored.select("text").mapInArrow(run, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))
           .collect())  # a row for each term of the batch
    return {bytes(r.term): r.n for r in got}


class Batch:
    """The terms of some items, their weights and what is known of the corpus."""

    def __init__(self, counts: list[Counter], df: dict[bytes, int], documents: int, total: int):
        import numpy as np
        self.documents, self.total = documents, total
        terms = sorted({t for c in counts for t in c})
        place = {t: i for i, t in enumerate(terms)}
        weight = {t: floor(1000 * log((2 * documents + 2) / (2 * df.get(t, 0) + 1))) for t in terms}
        self.items = [[(t, weight[t] * n) for t, n in c.items()] for c in counts]
        self.hash = np.fromiter(map(crc32, terms), np.int64, len(terms))
        self.term = np.array([place[t] for x in self.items for t, _ in x], np.int64)  # of each pair of item and term
        self.weight = np.array([w for x in self.items for _, w in x], np.int64)
        self.start = np.cumsum([0, *[len(x) for x in self.items[:-1]]])

    def length(self, n: int) -> int:
        return 75 + (25 * n * self.documents) // self.total

    def bounds(self, ns, sketches):
        """Upper bounds of the scores: a row for each document, a column for each item."""
        import numpy as np
        found = np.empty((len(ns), len(self.hash)), np.int64)
        tf = np.arange(256, dtype=np.int64)
        for r, (n, s) in enumerate(zip(ns, sketches)):
            s = np.frombuffer(s, np.uint8)
            impact = (UNIT * tf) // (1000 * tf + 12 * self.length(n))
            impact[255] = MOST
            found[r] = impact[s[self.hash & (len(s) - 1)]]
        return np.add.reduceat(found[:, self.term] * self.weight, self.start, axis=1)

    def score(self, count: Counter, n: int, item: int) -> int:
        m = 12 * self.length(n)
        return sum(w * ((UNIT * count[t]) // (1000 * count[t] + m)) for t, w in self.items[item] if t in count)

    def slices(self, rows: int):
        """Ranges of rows whose table of bounds stays below ``SLICE`` cells (a row at least)."""
        step = max(1, SLICE // max(len(self.term), 1))
        return [(a, min(a + step, rows)) for a in range(0, rows, step)]


def _highest(k: int, *by):
    return lambda df: (df.withColumn("place", F.row_number().over(Window.partitionBy("item").orderBy(*by)))
                       .filter(F.col("place") <= k).drop("place"))


def _first(stored: DataFrame, batch: Batch, k: int) -> DataFrame:
    """item, doc_id of the k highest bounds of each item."""
    kind = stored.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        bound = np.empty((len(batch.items), 0), np.int64)
        ids = np.empty((len(batch.items), 0), object)
        for b in batches:
            for a, z in batch.slices(b.num_rows):
                doc, ns, sk = (c.to_pylist() for c in b.slice(a, z - a).columns)
                new = batch.bounds(ns, sk).T
                bound = np.concatenate([bound, new], 1)
                ids = np.concatenate([ids, np.broadcast_to(np.array(doc, object), new.shape)], 1)
                if bound.shape[1] > k:
                    top = np.argpartition(-bound, k - 1, axis=1)[:, :k]
                    bound, ids = np.take_along_axis(bound, top, 1), np.take_along_axis(ids, top, 1)
        item = np.repeat(np.arange(len(batch.items), dtype=np.int32), bound.shape[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(ids.ravel().tolist(), to_arrow_type(kind)), pa.array(bound.ravel())],
            names=["item", "doc_id", "bound"])

    got = stored.select("doc_id", "n", "sketch").mapInArrow(
        run, f"item int, doc_id {kind.simpleString()}, bound long").filter("bound > 0 and doc_id is not null")
    return _highest(k, F.col("bound").desc(), "doc_id")(got).select("item", "doc_id").distinct()


def _thresholds(stored: DataFrame, batch: Batch, k: int) -> list[int]:
    """A score that k documents of each item reach; 1 where the first ones are fewer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [(i, batch.score(Counter(words(t)), n, i)) for i, t, n in zip(*(c.to_pylist() for c in b.columns))]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int32()),
                                              pa.array([g[1] for g in got], pa.int64())], names=["item", "score"])

    first = save(_first(stored, batch, k), "lexical-first")  # k rows an item
    scored = stored.join(first, "doc_id").select("item", "text", "n").mapInArrow(run, "item int, score long")
    low = (_highest(k, F.col("score").desc())(scored).groupBy("item").agg(F.min("score").alias("s"), F.count("*").alias("n"))
           .filter(F.col("n") >= k).collect())  # a row for each item of the batch
    out = [1] * len(batch.items)
    for r in low:
        out[r.item] = max(1, r.s)
    return out


def _rescore(stored: DataFrame, batch: Batch, thresholds: list[int], k: int) -> DataFrame:
    """item, doc_id, score: what a task finds among its k best of an item, by descending bound."""
    kind = stored.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        best: list[list] = [[] for _ in batch.items]
        low = np.array(thresholds, np.int64)
        for b in batches:
            for a, z in batch.slices(b.num_rows):
                part = b.slice(a, z - a)
                doc, ns, sk = (part.column(c).to_pylist() for c in ("doc_id", "n", "sketch"))
                text = part.column("text")
                bound = batch.bounds(ns, sk)
                counts: dict[int, Counter] = {}
                for i in np.flatnonzero((bound >= low).any(0)):
                    kept = best[i]
                    for r in np.argsort(-bound[:, i], kind="stable"):
                        if bound[r, i] < low[i]:
                            break
                        r = int(r)
                        if r not in counts:
                            counts[r] = Counter(words(text[r].as_py()))
                        s = batch.score(counts[r], ns[r], int(i))
                        if s >= low[i]:
                            d = doc[r]
                            kept.append((-s, d is None, d))
                            if len(kept) > k:
                                kept.sort()
                                kept.pop()
                            if len(kept) == k:
                                low[i] = max(low[i], -max(kept)[0])
        rows = [(i, d, -s) for i, kept in enumerate(best) for s, _, d in kept]
        cols = list(zip(*rows)) or [[]] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int32()), pa.array(cols[1], to_arrow_type(kind)), pa.array(cols[2], pa.int64())],
            names=["item", "doc_id", "score"])

    return stored.select("doc_id", "text", "n", "sketch").mapInArrow(
        run, f"item int, doc_id {kind.simpleString()}, score long")


def _batches(items: DataFrame) -> Iterator[list[tuple]]:
    """(item_id, terms) of the items that have terms, in batches of a bounded number of terms."""
    held, size = [], 0
    for r in items.select("item_id", "text").distinct().orderBy("item_id", "text").toLocalIterator():
        count = Counter(words(r.text))
        if not count:
            continue
        if held and size + len(count) > TERMS:
            yield held
            held, size = [], 0
        held.append((r.item_id, count))
        size += len(count)
    if held:
        yield held


def search(docs: DataFrame, items: DataFrame, k: int = K, room: int = ROOM) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of the highest scores of every item."""
    spark = docs.sparkSession
    item_type, kind = (t.schema[c].dataType.simpleString() for t, c in ((items, "item_id"), (docs, "doc_id")))
    stored = save(index(docs, room), "lexical-index")
    size = stored.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
    found = []
    for held in _batches(items) if size.n else ():
        counts = [c for _, c in held]
        batch = Batch(counts, frequencies(stored, sorted({t for c in counts for t in c})), size.n, size.l)
        got = _rescore(stored, batch, _thresholds(stored, batch, k), k)
        by = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(held)], f"item int, item_id {item_type}")
        found.append(save(got.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)
                          .join(names, "item").select("item_id", "rank", "doc_id", "score"), "lexical-found"))
    none = spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id {kind}, score long")
    return reduce(DataFrame.unionByName, found) if found else none


ORACLE_SQL = """
WITH t AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
d AS (SELECT doc_id, r, len(w) AS n, w FROM t WHERE len(w) > 0),
s AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM d),
p AS (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
      FROM (SELECT r, doc_id, n, unnest(w) AS term FROM d) GROUP BY r, term),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
q AS (SELECT item_id, term, count(*) AS c FROM (
        SELECT item_id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark))
      GROUP BY item_id, term),
x AS (
  SELECT q.item_id, p.r, any_value(p.doc_id) AS doc_id, CAST(sum(
    q.c * CAST(floor(1000 * ln((2 * s.nd + 2) / (2 * f.df + 1))) AS BIGINT)
    * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * p.n * s.nd) // s.l)))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN f USING (term) CROSS JOIN s GROUP BY q.item_id, p.r),
k AS (SELECT item_id, doc_id, score, row_number() OVER (
        PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
      FROM x WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 20
"""

__all__ = ["Batch", "K", "ORACLE_SQL", "index", "search", "sketch"]
