"""Stateless scoring accepts a streaming DataFrame (memory sink)."""

import tempfile

from pyspark.sql import functions as F

from riskloom.plans import scorecard as S
from riskloom.streaming.scoring import score_stream
from conftest import SF_SMALL


def test_stream_scoring_equals_batch(spark):
    prep = S.prepared_loans(spark, SF_SMALL)
    enc = S.fit_scorecard_encoder(prep)
    src = tempfile.mkdtemp(prefix="riskloom-stream-src-")
    prep.write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(prep.schema).parquet(src)
    q = score_stream(stream, enc, 0.1, "scored_stream_test")
    q.processAllAvailable()
    q.stop()
    got = spark.table("scored_stream_test")
    batch = S.graded(S.calibrated(S.fixed_score(prep, enc), 0.1))
    a = sorted((r.loan_id, r.p_cal, r.grade) for r in got.collect())
    b = sorted((r.loan_id, r.p_cal, r.grade) for r in batch.collect())
    assert a == b
