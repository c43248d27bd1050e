"""Merkle fixity audit of WARC archives (operator 7).

Each record of an archive is a leaf: its offset, length and SHA-256.  Leaves
are gathered by ranges of ``RANGE`` bytes of offset, and the ranges, ``FAN``
at a time, by ever larger ones up to a root for each archive; a node is the
SHA-256 of what lies below it in order of offset.  Two replicas are compared
root by root; only below nodes that differ are the next nodes compared, down
to the records.  A node has few children, so no task holds an archive.

Defined results: a record that only one replica has is ``missing`` (from the
second) or ``extra``; one that differs is ``corrupt``; records without archive
or offset take no part; a null record has length 0; repeated rows of a leaf
count once; of several records at one archive and offset, those that both
replicas have are sound, and the others are compared in order of length and
digest; equal replicas, and empty tables, give no rows; further columns are
ignored.  Repeated rows of a table of pages are records of their own, at
offsets one after the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import save

RANGE, FAN, COPIES = 1 << 16, 16, 4096
ARCHIVE = 500  # pages in an archive made from a table of pages


def leaves(records: DataFrame) -> DataFrame:
    """archive, offset, length, record_id, digest from archive, offset, record_id, record (binary)."""
    record = F.coalesce(F.col("record"), F.lit(b""))
    return (records.filter("archive is not null and offset is not null")
            .select("archive", F.col("offset").cast("long").alias("offset"), F.octet_length(record).alias("length"),
                    "record_id", F.sha2(record, 256).alias("digest")).distinct())


def _node(key: str) -> Column:
    rows = F.sort_array(F.collect_list(F.struct(F.col(key), F.col("digest"))))
    return F.sha2(F.array_join(F.transform(rows, lambda x: F.concat(x[key].cast("string"), F.lit(":"), x["digest"])),
                               "\n").cast("binary"), 256)


def tree(leaf: DataFrame, levels: int) -> list[DataFrame]:
    """Nodes (archive, idx, digest) of each level, ranges first; idx counts the ranges of a level."""
    text = leaf.select("archive", "offset", F.floor(F.col("offset") / RANGE).alias("idx"),
                       F.concat_ws(":", "length", "digest").alias("digest"))
    out = [text.groupBy("archive", "idx").agg(_node("offset").alias("digest"))]
    for _ in range(levels):
        below = out[-1].withColumn("up", F.floor(F.col("idx") / FAN))
        out.append(below.groupBy("archive", "up").agg(_node("idx").alias("digest"))
                   .select("archive", F.col("up").alias("idx"), "digest"))
    return out


def _differing(a: DataFrame, b: DataFrame, keys: list[str], value: str) -> DataFrame:
    pair = a.withColumnRenamed(value, "x").join(b.withColumnRenamed(value, "y"), keys, "full_outer")
    return pair.filter(~F.col("x").eqNullSafe(F.col("y")))


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """archive, offset, record_id, status, expected, found of each record that differs (leaves of two replicas)."""
    first, second = save(first, "fixity-first"), save(second, "fixity-second")
    top = first.select("offset").unionByName(second.select("offset")).agg(F.max("offset")).first()[0] or 0
    levels, reach = 0, RANGE
    while reach <= top:
        levels, reach = levels + 1, reach * FAN
    a, b = ([save(t, "fixity-tree") for t in tree(x, levels)] for x in (first, second))
    open_ = _differing(a[-1], b[-1], ["archive", "idx"], "digest").select("archive", "idx")
    for level in range(levels - 1, -1, -1):
        under = open_.select(F.col("archive"), F.col("idx").alias("up"))
        go = lambda t: (t.withColumn("up", F.floor(F.col("idx") / FAN))
                        .join(under, ["archive", "up"], "left_semi").drop("up"))  # noqa: B023
        open_ = save(_differing(go(a[level]), go(b[level]), ["archive", "idx"], "digest").select("archive", "idx"),
                     "fixity-open")
    def here(t: DataFrame) -> DataFrame:
        return (t.withColumn("idx", F.floor(F.col("offset") / RANGE))
                .join(open_, ["archive", "idx"], "left_semi")
                .select("archive", "offset", F.struct("length", "digest").alias("leaf"), "record_id"))

    same = ["archive", "offset", "leaf"]
    nth = Window.partitionBy("archive", "offset").orderBy("leaf", "record_id")

    def lone(t: DataFrame, other: DataFrame, mark: str) -> DataFrame:
        """Records that the other replica does not have, numbered where several share an offset."""
        only = here(t).join(here(other).select(*same), same, "left_anti")
        return (only.withColumn("nth", F.row_number().over(nth))
                .select("archive", "offset", "nth", F.col("leaf").alias(mark), F.col("record_id").alias(f"{mark}_id")))

    pair = lone(first, second, "x").join(lone(second, first, "y"), ["archive", "offset", "nth"], "full_outer")
    status = (F.when(F.col("y").isNull(), "missing").when(F.col("x").isNull(), "extra").otherwise("corrupt"))
    return pair.select("archive", "offset", F.coalesce("x_id", "y_id").alias("record_id"), status.alias("status"),
                       F.col("x.digest").alias("expected"), F.col("y.digest").alias("found"))


def hashed(salt: str, key: Column, n: Column | int) -> Column:
    """32 bits of md5 of the salted key, modulo n."""
    text = F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % F.lit(n)


def page_archives(pages: DataFrame, archive: int = ARCHIVE) -> DataFrame:
    """Response records (archive, offset, record_id, record as text) of a table of pages."""
    n = max(1, -(-pages.count() // archive))
    html, url = F.coalesce(F.col("html"), F.lit("")), F.coalesce(F.col("url"), F.lit(""))
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">\r\nWARC-Target-URI: "), url,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(html).cast("string"),
        F.lit("\r\n\r\n"), html, F.lit("\r\n\r\n"))
    made = pages.select(hashed("archive:", F.col("page_id"), n).alias("archive"), F.col("page_id").alias("record_id"),
                        record.alias("text"))
    # offsets from lengths only; equal rows are one group with a range of offsets
    same = ["archive", "rid", "no_id", "size", "check"]  # no nulls: the join finds the texts dealt out by these already
    made = (made.withColumn("size", F.octet_length("text")).withColumn("check", F.xxhash64("text"))
            .withColumn("rid", F.coalesce(F.col("record_id").cast("string"), F.lit("")))
            .withColumn("no_id", F.col("record_id").isNull()))
    upto = Window.partitionBy("archive").orderBy("record_id", "size", "check").rowsBetween(
        Window.unboundedPreceding, -1)
    at = save(made.groupBy(*same, "record_id").agg(F.count(F.lit(1)).alias("rows"))
              .withColumn("offset", F.coalesce(F.sum(F.col("size") * F.col("rows")).over(upto), F.lit(0)).cast("long"))
              .select(*same, "offset", "rows"), "fixity-offsets")
    # one text a group: texts are shuffled once, for both kinds of groups
    placed = lambda rows: made.dropDuplicates(same).join(at.filter(rows), same)
    out = ["archive", "offset", "record_id", "text"]
    single = placed("rows = 1").select(*out)
    # dealt out again in blocks of copies
    many = (placed("rows > 1")
            .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1,
                                                      F.lit(COPIES).cast("long"))))
            .repartition("archive", "record_id", "check", "block")
            .withColumn("k", F.explode(F.sequence("block", F.least(F.col("block") + COPIES, F.col("rows")) - 1)))
            .withColumn("offset", F.col("offset") + F.col("k") * F.col("size")))
    return single.unionByName(many.select(*out))


def damaged(records: DataFrame, one_in: int = 50) -> DataFrame:
    """A second replica: of every ``one_in`` records, by hash, one has a changed middle and one is lost."""
    fate = hashed("damage:", F.col("record_id"), one_in)
    middle = F.floor(F.length("text") / 2).cast("int")
    mark = F.when(F.substr("text", middle, F.lit(1)) == "#", "%").otherwise("#")
    changed = F.concat(F.substr("text", F.lit(1), middle - 1), mark, F.substr("text", middle + 1))
    return records.filter(fate != 1).withColumn("text", F.when(fate == 0, changed).otherwise(F.col("text")))


def as_records(rows: DataFrame) -> DataFrame:
    return rows.select("archive", "offset", "record_id", F.col("text").cast("binary").alias("record"))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """archive (file), offset, record_id, record of uncompressed WARC files of at most 2 GB each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re
        name = re.compile(rb"(?im)^warc-record-id:\s*(.*?)\s*$")
        size = re.compile(rb"(?im)^content-length:\s*(\d+)")
        for b in batches:
            for file, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                at = raw.find(b"WARC/")
                while at >= 0:
                    head = raw.find(b"\r\n\r\n", at)
                    if head < 0:
                        break
                    block = raw[at:head + 2]
                    n, rid = size.search(block), name.search(block)
                    end = min(len(raw), head + 4 + (int(n[1]) if n else 0) + 4)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([file]), pa.array([at], pa.int64()),
                         pa.array([rid[1].decode("utf-8", "replace") if rid else None], pa.string()),
                         pa.array([raw[at:end]], pa.binary())], names=["archive", "offset", "record_id", "record"])
                    at = raw.find(b"WARC/", end)

    return (spark.read.format("binaryFile").load(path).select("path", "content")
            .mapInArrow(run, "archive string, offset long, record_id string, record binary"))


ORACLE_SQL = r"""
WITH n AS (SELECT greatest(1, CAST(ceil(count(*) / 500.0) AS BIGINT)) AS n FROM pages),
r AS (
  SELECT CAST('0x' || substr(md5('archive:' || CAST(page_id AS VARCHAR)), 1, 8) AS BIGINT) % n.n AS archive,
         page_id AS record_id,
         CAST('0x' || substr(md5('damage:' || CAST(page_id AS VARCHAR)), 1, 8) AS BIGINT) % 50 AS fate,
         concat('WARC/1.1', chr(13), chr(10), 'WARC-Type: response', chr(13), chr(10), 'WARC-Record-ID: <urn:page:',
                CAST(page_id AS VARCHAR), '>', chr(13), chr(10), 'WARC-Target-URI: ', coalesce(url, ''), chr(13), chr(10),
                'Content-Type: text/html', chr(13), chr(10), 'Content-Length: ',
                CAST(strlen(coalesce(html, '')) AS VARCHAR), chr(13), chr(10), chr(13), chr(10),
                coalesce(html, ''), chr(13), chr(10), chr(13), chr(10)) AS text
  FROM pages, n),
o AS (
  SELECT *, CAST(coalesce(sum(strlen(text)) OVER (PARTITION BY archive ORDER BY record_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
         CAST(floor(length(text) / 2) AS BIGINT) AS m
  FROM r)
SELECT archive, "offset", record_id, CASE fate WHEN 1 THEN 'missing' ELSE 'corrupt' END AS status,
       sha256(text) AS expected,
       CASE fate WHEN 0 THEN sha256(concat(substr(text, 1, m - 1),
            CASE WHEN substr(text, m, 1) = '#' THEN '%' ELSE '#' END, substr(text, m + 1))) END AS found
FROM o WHERE fate IN (0, 1)
"""

__all__ = ["ORACLE_SQL", "as_records", "audit", "damaged", "leaves", "page_archives", "read_warc", "tree"]
