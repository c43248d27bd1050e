"""Scoring new loans as a stream.

Encoding (literal WoE lookups), the scorecard score, the calibration offset
and the grade are all row-wise expressions, so the same functions serve a
streaming DataFrame: no state, no watermark.  Fitting stays a batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.woe import Encoder
from ..plans import scorecard as S
from ..session import scratch_path


def score_frame(df: DataFrame, enc: Encoder, offset: float,
                keep=("loan_id", "cohort", "y")) -> DataFrame:
    """Batch or streaming: loan_id, cohort, y, p, p_cal, grade."""
    return S.graded(S.calibrated(S.fixed_score(df, enc, keep), offset))


def score_stream(stream: DataFrame, enc: Encoder, offset: float, query_name: str,
                 sink: str = "memory", path: str | None = None,
                 checkpoint: str | None = None) -> StreamingQuery:
    """Start an append-mode query writing scored loans to ``sink``."""
    spark = stream.sparkSession
    out = score_frame(stream, enc, offset)
    w = (out.writeStream.outputMode("append").queryName(query_name)
         .option("checkpointLocation", checkpoint or scratch_path(spark, f"stream-{query_name}")))
    if sink == "memory":
        return w.format("memory").start()
    return w.format(sink).start(path)
