"""A saved scorecard gives the same scores after loading, in batch and stream."""

import os
import subprocess
import sys
import tempfile

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL
from riskloom.plans import scorecard as S
from riskloom.sources.files import describe, read_dictionary

OTHER_SESSION = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.ml import PipelineModel
from riskloom.session import build_session
s = build_session("local[2]", shuffle_partitions=2)
rows = s.read.parquet(sys.argv[3])
PipelineModel.load(sys.argv[2]).transform(rows).select("loan_id", "p", "p_cal", "grade").write.parquet(sys.argv[4])
s.stop()
"""


def _rows(df):
    return sorted(map(tuple, df.select("loan_id", "p", "p_cal", "grade").collect()))


def test_save_and_load(spark):
    prep = S.prepared_loans(spark, SF_SMALL)
    enc = S.fit_scorecard_encoder(prep)
    base = tempfile.mkdtemp(prefix="riskloom-saved-")
    model, path, source = S.scoring_pipeline(enc, 0.1), f"{base}/model", f"{base}/rows"
    # a level and a NULL that the fit has not seen
    odd = (prep.limit(2).withColumn("segment", F.lit("NEVER SEEN")).withColumn("priority", F.lit(None).cast("string"))
           .withColumn("loan_id", -F.col("loan_id")))
    prep.unionByName(odd).write.parquet(source)
    rows = spark.read.parquet(source)
    want = _rows(S.graded(S.calibrated(S.fixed_score(rows, enc), 0.1)))
    assert _rows(model.transform(rows)) == want
    model.write().save(path)
    loaded = PipelineModel.load(path)
    assert [s.uid for s in loaded.stages] == [s.uid for s in model.stages]
    assert _rows(loaded.transform(rows)) == want
    first = {f: enc.bins[f].first for f in S.CATEGORICAL}
    unseen = loaded.stages[0].transform(rows.where("loan_id < 0")).collect()
    assert unseen and all(r["_rl_woe_segment"] == first["segment"] for r in unseen)

    q = (loaded.transform(spark.readStream.schema(rows.schema).parquet(source)).select("loan_id", "p", "p_cal", "grade")
         .writeStream.format("memory").queryName("saved_stream_test")
         .option("checkpointLocation", f"{base}/stream").start())
    q.processAllAvailable()
    q.stop()
    assert _rows(spark.table("saved_stream_test")) == want

    # another process: nothing of this session is needed
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_GATEWAY", "SPARK_"))}
    subprocess.run([sys.executable, "-c", OTHER_SESSION, ROOT, path, source, f"{base}/out"], check=True, env=env,
                   timeout=300)
    assert _rows(spark.read.parquet(f"{base}/out")) == want


def test_dictionary(spark, tmp_path):
    (tmp_path / "words.csv").write_text("feature;description\n a ;First\nb;Late\nb;Early\n;Nobody\nz;Not used\n")
    table = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "feature string, iv double")
    got = describe(table, read_dictionary(spark, str(tmp_path / "words.csv"))).collect()
    assert {r.feature: r.description for r in got} == {"a": "First", "b": "Early", "c": None} and len(got) == 3
