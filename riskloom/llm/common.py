"""Helpers shared by the training-data operators.

``save`` cuts lineage with a table written in the shared folder that the
session names in ``spark.checkpoint.dir``; such a table outlives a lost
executor.  ``neighbours`` runs a function over each row of a globally sorted
table together with the rows before and after it, without a global window.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once in the shared folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(col: Column, n: int) -> Column:
    """crc32 of the value written as text, modulo n (null value: null)."""
    return F.crc32(col.cast("string").cast("binary")) % F.lit(n)


def temp(name: str) -> str:
    """A column name that no input column has."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def by_batch(df: DataFrame, schema: str | T.StructType,
             rows: Callable[[dict[str, list]], dict[str, list]]) -> DataFrame:
    """``rows`` maps the columns of one bounded Arrow batch to output columns."""
    out = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                got = rows({n: c.to_pylist() for n, c in zip(b.schema.names, b.columns)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(got[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, out)


def worker_cache() -> dict:
    """A dictionary that a Python worker keeps between its tasks.

    Task functions are sent by value, so globals of this package start anew in
    each task; what is dear to build (a tokenizer) is kept with the process.
    """
    import sys
    import types
    name = "_riskloom_worker_cache"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
    return sys.modules[name].__dict__.setdefault("kept", {})


def trim_memory() -> None:
    """Give the pages of freed small objects back to the system, where the C library can (after a fit on the driver)."""
    import ctypes
    import gc
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def free_worker() -> None:
    """Drop what a worker keeps for other operators, and give the memory back (in a task)."""
    if worker_cache():
        worker_cache().clear()
        trim_memory()


def neighbours(df: DataFrame, deal: list[Column], order: list[Column], rows: Callable, schema: str,
               partitions: int, wrap: bool = False) -> DataFrame:
    """Apply ``rows`` to runs of a globally sorted table.

    ``rows(cells, first, last)`` gets consecutive rows as a list of tuples and
    yields the output tuples of rows ``first`` to ``last - 1`` of them; the
    rows around those are there only as context (one on either side, or None
    at the ends of the whole table; with ``wrap`` the table is a ring).

    The table is dealt out by range of ``deal``, the first columns of ``order``
    (short ones: samples of them reach the driver), so no task holds more than
    its share; ``order`` also holds what makes the order complete.  The first
    and last row of a partition lack a neighbour: they and the rows beside them
    (four a partition) are read from the same exchange and meet in groups of
    three.  The window over partition numbers has one row a partition.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    out = T.StructType.fromDDL(schema)
    target = to_arrow_schema(out)
    names = df.columns
    dealt = df.repartitionByRange(partitions, *deal).sortWithinPartitions(*order)

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # a row of context and the row that waits for its successor
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                held += zip(*(c.to_pylist() for c in b.slice(at, 1000).columns))
                if len(held) > 2:
                    cols = list(zip(*rows(held, 1, len(held) - 1)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), f.type) for c, f in zip(cols, target)], schema=target)
                    held = held[-2:]

    edge_type = T.StructType([T.StructField("pid", T.IntegerType()), T.StructField("slot", T.StringType()),
                              *[T.StructField(f"in_{f.name}", f.dataType) for f in df.schema]])
    edge_schema = to_arrow_schema(edge_type)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        lead, tail = None, None  # the first and the last two rows
        for b in batches:
            if b.num_rows:
                lead = b.slice(0, 2) if lead is None else lead if lead.num_rows > 1 else _two(lead, b, True)
                tail = b.slice(max(0, b.num_rows - 2)) if tail is None or b.num_rows > 1 else _two(tail, b, False)
        if lead is None:
            return
        if lead.num_rows == 1:
            wanted = [("first", lead, 0), ("only", lead, 0), ("last", lead, 0)]
        else:
            wanted = [("first", lead, 0), ("second", lead, 1), ("before", tail, 0), ("last", tail, 1)]
        for slot, b, at in wanted:
            yield pa.RecordBatch.from_arrays(
                [pa.array([pid], pa.int32()), pa.array([slot]), *[c.slice(at, 1) for c in b.columns]],
                names=edge_schema.names)

    def _two(x: pa.RecordBatch, y: pa.RecordBatch, first: bool) -> pa.RecordBatch:
        both = pa.Table.from_batches([x, y]).combine_chunks()
        return (both.slice(0, 2) if first else both.slice(max(0, both.num_rows - 2))).to_batches()[0]

    edge = dealt.mapInArrow(ends, edge_type)
    by = Window.orderBy("pid")
    last, first = ((F.max("pid").over(Window.partitionBy()), F.min("pid").over(Window.partitionBy())) if wrap
                   else (F.lit(None), F.lit(None)))
    where = (edge.groupBy("pid").agg(F.max(F.col("slot") == "only").alias("single"))
             .select("pid", "single", F.coalesce(F.lag("pid").over(by), last).alias("p"),
                     F.coalesce(F.lead("pid").over(by), first).alias("q")))
    me, twice = F.col("pid"), (F.col("pid") * 2).cast("long")

    def place(group: Column, at: int, pid: Column, slot: str) -> Column:
        return F.struct(group.alias("grp"), F.lit(at).alias("place"), pid.alias("from_pid"), F.lit(slot).alias("from_slot"))

    alone = F.array(place(twice, 0, F.col("p"), "last"), place(twice, 1, me, "only"), place(twice, 2, F.col("q"), "first"))
    ends2 = F.array(place(twice, 0, F.col("p"), "last"), place(twice, 1, me, "first"), place(twice, 2, me, "second"),
                    place(twice + 1, 0, me, "before"), place(twice + 1, 1, me, "last"),
                    place(twice + 1, 2, F.col("q"), "first"))
    where = where.select(F.explode(F.when(F.col("single"), alone).otherwise(ends2)).alias("x")).select("x.*")
    near = edge.join(where, (F.col("pid") == F.col("from_pid")) & (F.col("slot") == F.col("from_slot")))

    def at_edge(key, batch):
        cells = {r[0]: tuple(r[1:]) for r in zip(*(batch.column(c).to_pylist()
                 for c in ["place", *[f"in_{x}" for x in names]]))}
        cols = list(zip(*rows([cells.get(0), cells[1], cells.get(2)], 1, 2)))
        return pa.table([pa.array(list(c), f.type) for c, f in zip(cols, target)], schema=target)

    near = near.select("grp", "place", *[f"in_{c}" for c in names])
    return dealt.mapInArrow(inner, out).unionByName(near.groupBy("grp").applyInArrow(at_edge, out))


def parts(df: DataFrame, least: int = 1) -> int:
    """Partitions for an exchange by range: the session's shuffle setting."""
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


__all__ = ["by_batch", "free_worker", "neighbours", "parts", "read", "remainder", "save", "temp", "trim_memory", "worker_cache"]
