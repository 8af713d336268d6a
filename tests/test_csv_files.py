"""CSV files of bounded size."""

from scriptorium.session import work_dir
from scriptorium.sources import files as I


def test_files_of_bounded_size_are_read_by_ranges(spark):
    rows = [(i, f'a "{i}"\n{"x" * 90},') for i in range(400)] + [(400, None), (401, "")]
    df, path = spark.createDataFrame(rows, "n long, t string").repartition(8).cache(), work_dir(spark, "csv")
    I.write_csv(df, f"{path}/many", file_bytes=10_000)
    I.write_csv(df, f"{path}/one", file_bytes=1 << 20)
    I.write_csv(df.limit(0), f"{path}/none", file_bytes=1 << 20)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(path)
    sizes = [(r.path.split("/")[-2], r.length) for r in found.select("path", "length").collect()]
    many = [n for at, n in sizes if at == "many"]
    assert 4 <= len(many) <= 8 and max(many) < 20_000
    assert len([1 for at, _ in sizes if at == "one"]) == 1
    for at in ("many", "one"):
        assert sorted(map(tuple, I.read_csv_ranges(spark, f"{path}/{at}", df.schema).collect()), key=lambda r: r[0]) == rows
    assert I.read_csv_ranges(spark, f"{path}/none", df.schema).count() == 0
