"""SimHash near-duplicates by multi-index hashing (operator 6).

A text is lower-cased (A-Z), cut into words at ASCII white space, and each
run of ``words`` words, joined by a space, is hashed (XXH64, seed 42).  Bit i
of the fingerprint is set if it is set in over half of the hashes.  A text of
fewer words is one run; a text without words (or null) has fingerprint 0.

Two fingerprints link if they differ in ``distance`` bits or fewer.  The 64
bits are cut into ``segments``; two linked fingerprints differ in at most
``distance // segments`` bits of some segment.  Each distinct fingerprint puts
its segments into tables and asks the tables for its ball around each segment;
every match is verified over all 64 bits.  A ball of radius 1 only flips bits
that are 0: of two segments that differ in one bit, one has the 0.

Groups of thousands of near copies share many table entries, so pairs within
an entry are not all formed: first every asker of an entry is compared with
one fingerprint of the entry, and the links found are joined to components.
Then pairs are formed only between different components, and only in the
entries that still hold several.  No link between different fingerprints that
could join two components is left out: the result is that of all pairs.

Defined results: repeated rows and exact copies have equal fingerprints and
so one component; null texts count as empty; null document numbers take part
but name no component (component_id is null if there is no other number);
further input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import save, temp, worker_cache
from .components import components

WORDS, DISTANCE, SEGMENTS = 4, 4, 3


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The 64-bit fingerprint of one text, as an unsigned number."""
    import numpy as np
    import xxhash
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    one = b" ".join(w)
    ends, at = [], -1
    for x in w:
        at += len(x) + 1
        ends.append(at)
    k = len(w) - words + 1
    if k <= 1:
        return xxhash.xxh64_intdigest(one, 42)
    starts = [0, *[e + 1 for e in ends[:k - 1]]]
    h64, total, step = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 1 << 16
    for a in range(0, k, step):  # bounded memory for very long texts
        h = np.array([h64(one[s:e], 42) for s, e in zip(starts[a:a + step], ends[words - 1 + a:])],
                     dtype="<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > k, bitorder="little").tobytes(), "little")


def with_fingerprints(docs: DataFrame, words: int = WORDS, name: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of ``text`` as a long (its bits as two's complement)."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        worker_cache().clear()  # what a worker keeps for other operators
        for b in batches:
            got = np.array([fingerprint(x.as_py(), words) for x in b.columns[at]], np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got.view(np.int64))],
                                             names=[*b.schema.names, name])

    return docs.mapInArrow(run, schema)


def _index(fps: DataFrame, distance: int, segments: int) -> DataFrame:
    """key, asks, fp, label, few of each table entry and each question to a table.

    key holds the segment's number and value; ``asks`` is false for entries.
    """
    widths = [64 // segments + (i < 64 % segments) for i in range(segments)]
    radius = distance // segments

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import combinations
        import numpy as np
        for b in batches:
            cells = {n: c.to_numpy(zero_copy_only=False) for n, c in zip(b.schema.names, b.columns)}
            for a in range(0, b.num_rows, 2000):
                fp = cells["fp"][a:a + 2000].view(np.uint64)
                row = np.arange(len(fp))
                at, keys, asks = [], [], []
                low = 0
                for s, width in enumerate(widths):
                    value = (fp >> np.uint64(low)) & np.uint64((1 << width) - 1)
                    low += width
                    head = np.uint64(s << 58) if width < 58 else np.uint64(0)
                    at.append(row), keys.append(value | head), asks.append(np.zeros(len(fp), bool))
                    for r in range(1, radius + 1):
                        for bits in combinations(range(width), r):
                            mask = np.uint64(sum(1 << i for i in bits))
                            # with one bit flipped, the side that has the 0 asks
                            on = (value & mask) == 0 if r == 1 else np.ones(len(fp), bool)
                            at.append(row[on]), keys.append((value ^ mask)[on] | head)
                            asks.append(np.ones(int(on.sum()), bool))
                i = np.concatenate(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(asks)),
                     *[pa.array(cells[c][a:a + 2000][i]) for c in ("fp", "label", "few")]],
                    names=["key", "asks", "fp", "label", "few"])

    return fps.select("fp", "label", "few").mapInArrow(run, "key long, asks boolean, fp long, label long, few long")


def _differ(a: str, b: str) -> F.Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def link(fps: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """fp, root of the fingerprints that have a link; ``fps``: distinct fp, and few = -documents."""
    start = fps.select("fp", F.col("fp").alias("label"), "few")
    # 1. each asker with one fingerprint of the entry: the one of most documents
    index = _index(start, distance, segments)
    centre = (index.groupBy("key").agg(
        F.min(F.when(~F.col("asks"), F.struct("few", "fp"))).alias("c"), F.count("*").alias("n"))
        .filter("n > 1 and c is not null").select("key", F.col("c.fp").alias("centre")))
    # Spark sizes an index by the table it is made from, a row a fingerprint, but it has dozens: merged, never broadcast
    near = index.join(centre.hint("merge"), "key").filter((F.col("fp") != F.col("centre"))
                                                          & (_differ("fp", "centre") <= distance))
    first = save(components(near.select(F.col("fp").alias("a"), F.col("centre").alias("b")), "simhash-stars"),
                 "simhash-first")
    labelled = save(start.drop("label").join(first.select(F.col("node").alias("fp"), F.col("root").alias("r")),
                                             "fp", "left")
                    .select("fp", F.coalesce("r", "fp").alias("label"), "few"), "simhash-labels")
    # 2. between components, in the entries that hold several; an entry of one fingerprint
    # was compared with all its askers above
    index = _index(labelled, distance, segments)
    mixed = (index.groupBy("key").agg(
        F.min(F.when(~F.col("asks"), F.struct("few", "fp", "label"))).alias("c"),
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.count_if(~F.col("asks")).alias("held"))
        .filter("lo <> hi and held > 1").select("key", F.col("c.label").alias("main")))
    rows = save(index.join(mixed.hint("merge"), "key").select("key", "asks", "fp", "label", "main"), "simhash-mixed")
    other = rows.filter("label <> main").select(
        "key", F.col("asks").alias("asks2"), F.col("fp").alias("fp2"), F.col("label").alias("label2"))
    pairs = (rows.join(other.hint("merge"), (rows["key"] == other["key"]) & (F.col("label") != F.col("label2"))
                       & (~F.col("asks") | ~F.col("asks2")) & (_differ("fp", "fp2") <= distance))
             .select(F.col("label").alias("a"), F.col("label2").alias("b")))
    second = components(pairs, "simhash-links").select(F.col("node").alias("label"), F.col("root").alias("r"))
    merged = labelled.join(second, "label", "left").select("fp", F.coalesce("r", "label").alias("root"))
    return merged


def near_duplicates(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE,
                    segments: int = SEGMENTS) -> DataFrame:
    """doc_id, fp, root (a fingerprint that names the component), component_id of every document."""
    prints = save(with_fingerprints(docs.select("doc_id", "text"), words).select("doc_id", "fp"), "simhash-fp")
    return group(prints, distance, segments)


def group(prints: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """As ``near_duplicates``, from a saved table of doc_id and fp."""
    fps = save(prints.groupBy("fp").agg((-F.count("*")).alias("few"), F.min("doc_id").alias("least")),
               "simhash-distinct")
    roots = save(link(fps, distance, segments).join(fps.select("fp", "least"), "fp"), "simhash-roots")
    ids = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.select("fp", "root").join(ids, "root")
    return prints.join(named, "fp").select("doc_id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """The rows of ``docs``, all columns, with the smallest document number of each component.

    Of several rows with that number (repeated rows) one stays; a component
    without any number keeps one row.
    """
    fp = temp("fp")
    marked = save(with_fingerprints(docs, words, fp), "simhash-marked")  # texts are fingerprinted once
    kept = group(marked.select("doc_id", F.col(fp).alias("fp")), distance, segments)
    kept = (kept.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root")
            .agg(F.min("fp").alias("k_fp"), F.min("doc_id").alias("k_id")).drop("root"))
    same = (F.col(fp) == F.col("k_fp")) & F.col("doc_id").eqNullSafe(F.col("k_id"))
    return marked.join(kept, same).dropDuplicates(["k_fp", "k_id"]).select(*docs.columns)


def digest(fp: F.Column) -> F.Column:
    """16 lowercase hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


__all__ = ["DISTANCE", "SEGMENTS", "WORDS", "digest", "fingerprint", "group", "keep_one", "link", "near_duplicates",
           "with_fingerprints"]
