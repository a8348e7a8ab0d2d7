from __future__ import annotations

from pyspark.sql import functions as F

from catalog import fixture
from catalog import stream_queries as S
from edgelog import layouts as L
from edgelog.sources import readers
from edgelog.streaming import runner


def test_a_batch_lies_in_several_files_and_is_its_frame(spark, tmp_path, monkeypatch):
    """Frames of 25, 4, 0 and 1 rows: the first needs three files, and every batch is one frame."""
    monkeypatch.setattr(S, "_FILE_ROWS", 10)
    sizes = [range(25), range(25, 29), range(0), range(29, 30)]
    frames = [spark.createDataFrame([(str(i),) for i in ids], "value string") for ids in sizes]
    files = S._files(frames[:3], str(tmp_path / "in"))
    assert S._files(frames[3:], *files) == files
    assert files.width == 3 and S._written(spark, files.path) == 12
    seen = {}
    handler = lambda df, batch: seen.update({batch: sorted(int(r.value) for r in df.collect())})
    runner.run_stream(S._source(spark, files), handler, str(tmp_path / "c")).awaitTermination()
    assert seen == {batch: list(ids) for batch, ids in enumerate(sizes) if ids}  # an empty batch is not handled


def test_events_of_a_batch_are_parsed_once(spark, sf, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def seen(line):
        read.add(1)
        return line

    lines = fixture.lines(spark, sf, L.VENDOR_37).select(F.udf(seen, "string")("value").alias("value"))
    runner.event_handler(str(tmp_path))(lines, 0)
    assert read.value == fixture.lines(spark, sf, L.VENDOR_37).count()
    assert spark.read.parquet(f"{tmp_path}/quarantine").count() > 0


def test_batches_generate_no_method_too_long_to_compile(spark, tmp_path):
    key, found = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(key)
    spark.conf.set(key, "65535")
    try:
        spark.createDataFrame([("a",)], "value string").write.parquet(f"{tmp_path}/in")
        stream = readers.source(spark, "parquet", L.RAW_LINE_SCHEMA, f"{tmp_path}/in")
        runner.run_stream(stream, lambda df, batch: found.append(df.sparkSession.conf.get(key)), f"{tmp_path}/c").awaitTermination()
        assert found == ["8000"] and spark.conf.get(key) == "65535"
    finally:
        spark.conf.set(key, before)
