"""Tables written once per version of their sources."""

import time

from riskloom.session import materialize_once, source_version


def test_written_once_until_a_source_changes(spark, tmp_path):
    src = str(tmp_path / "src.parquet")
    spark.range(5).write.parquet(src)
    built = []

    def build():
        built.append(1)
        return spark.read.parquet(src)

    first = materialize_once(spark, "once", [src], build)
    again = materialize_once(spark, "once", [src], build)
    assert len(built) == 1 and first.inputFiles() == again.inputFiles()
    before = source_version(spark, src)
    time.sleep(1.1)
    spark.range(7).write.mode("overwrite").parquet(src)
    assert source_version(spark, src) != before
    assert materialize_once(spark, "once", [src], build).count() == 7 and len(built) == 2


def test_a_removed_table_is_written_again(spark, tmp_path):
    src = str(tmp_path / "src.parquet")
    spark.range(3).write.parquet(src)
    from riskloom import session
    materialize_once(spark, "gone", [src], lambda: spark.read.parquet(src))
    key = next(k for k in session._shared if k[2] == "gone" and k[3][0] == src)
    session._shared[key] += "-gone"
    assert materialize_once(spark, "gone", [src], lambda: spark.read.parquet(src)).count() == 3
