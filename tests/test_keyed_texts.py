"""A text file per key: as Spark's partitioned writer lays them out, and read back by few tasks."""

import os

from pyspark.sql import functions as F

from scriptorium.sources import files as I


def contents(path):
    return {d[len(path):]: [open(os.path.join(d, f), "rb").read() for f in names if f.startswith("part-")] for d, _, names in os.walk(path) if d != path}


def test_folders_and_bytes_are_those_of_the_partitioned_writer(spark, tmp_path):
    rows = spark.createDataFrame([("a", "one"), ("b", "é\nx"), ("b", "é\nx"), ("a/b=c%d", "two"), ("", "none"), (None, "none"), ("ü [x]^{y}'*?\\#\":\x01\x7f~", None)], "k string, v string")
    for path in ("plain", "ours"):
        os.makedirs(tmp_path / path / "k=old")  # goes
    rows.repartition("k").write.mode("overwrite").partitionBy("k").text(str(tmp_path / "plain"))
    I.write_keyed_texts(rows, "k", "v", str(tmp_path / "ours"))
    assert contents(str(tmp_path / "ours")) == contents(str(tmp_path / "plain"))
    assert {f for _, _, names in os.walk(tmp_path / "ours") for f in names if not f.startswith("part-")} <= {"_SUCCESS", "._SUCCESS.crc"}
    back = I.read_whole_text(spark, str(tmp_path / "ours"), F.regexp_extract("_metadata.file_path", "k=([a-z])/", 1), nested=True)
    assert {(r.name, r.text) for r in back.where("name <> ''").collect()} == {("a", "one\n"), ("b", "é\nx\né\nx\n")}


def test_no_rows(spark, tmp_path):
    I.write_keyed_texts(spark.createDataFrame([], "k long, v string"), "k", "v", str(tmp_path / "none"))
    assert I.read_whole_text(spark, str(tmp_path / "none"), nested=True).count() == 0


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    path = str(tmp_path / "many")
    I.write_keyed_texts(spark.range(300).select("id", F.concat(F.lit("<p>"), "id").alias("v")), "id", "v", path)
    context, most = spark.sparkContext, "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(most)
    for name, read in (("html", I.read_html_files), ("text", I.read_whole_text)):
        context.setJobGroup(name, name)
        found = read(spark, path, glob="*.txt", nested=True)
        tracker = context.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup(name) for s in tracker.getJobInfo(j).stageIds]
        assert stages and max(tracker.getStageInfo(s).numTasks for s in stages) <= 64
        assert found.count() == 300
    assert spark.conf.get(most) == before
