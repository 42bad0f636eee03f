import shutil

from pyspark.sql import functions as F

from metaseries.streaming import pooled

SF = "/root/testdata/sf0.001"


def test_a_stream_equals_its_batch_and_takes_up_again(spark, tmp_path):
    folder, state = tmp_path / "in", str(tmp_path / "state")
    folder.mkdir()
    shutil.copy(f"{SF}/events.parquet", folder / "events.parquet")
    found = pooled.run_available(spark, str(folder), checkpoint=state).collect()
    batch = pooled.windowed_means(spark.read.parquet(f"{SF}/events.parquet")).collect()
    assert {(r.start, r.event_type, r.n) for r in found} == {(r.start, r.event_type, r.n) for r in batch}
    again = pooled.run_available(spark, str(folder), checkpoint=state)
    assert again.agg(F.sum("n")).first()[0] == sum(r.n for r in batch)
    # more of the same days: windows that the watermark has not passed change, older ones stay
    newest = spark.read.parquet(f"{SF}/events.parquet").agg(F.max("ts")).first()[0]
    more = spark.read.parquet(f"{SF}/events.parquet").where(F.col("ts") >= newest).limit(1)
    (folder / "later").mkdir()
    more.coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "more"))
    part = next((tmp_path / "more").glob("part-*.parquet"))
    shutil.copy(part, folder / "later" / "events.parquet")
    (folder / "later" / "events.parquet").rename(folder / "events-2.parquet")
    found = pooled.run_available(spark, str(folder), name="events*.parquet", checkpoint=state)
    assert found.agg(F.sum("n")).first()[0] == sum(r.n for r in batch) + 1 and found.count() == len(batch)
