"""Landing of files in chunks: tasks list and read them, the driver's readers do not; the same rows as those readers give."""

import random

import pytest

from scriptorium.sources import files as I


@pytest.fixture
def tree(tmp_path):
    rng = random.Random(8)
    held = {"a.txt": b"x" * 100, "b c+%41.txt": "é\r\n".encode() * 40, "empty.txt": b"", "k=1/part.txt": rng.randbytes(333), "k=1/deep/er/n.txt": b"\n", "_k=2/part.txt": b"kept",
            "_hidden/a.txt": b"no", ".dot/a.txt": b"no", "_SUCCESS": b"no", "k=1/.part.txt.crc": b"no", "other.log": b"log", "z.txt.gz": rng.randbytes(64), "y.txt._COPYING_": b"no",
            "_metadata/a.txt": b"in", "_metadata_of.txt": b"no"}
    for name, data in held.items():
        at = tmp_path / "in" / name
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_bytes(data)
    (tmp_path / "in" / "gone.txt").symlink_to(tmp_path / "nowhere")
    return tmp_path


@pytest.mark.parametrize("glob", ["*", "*.txt", "{a,n,part}.t?t", "[!ab]*.txt", "*.gz"])
def test_the_rows_of_the_readers(spark, tree, glob):
    I.land_chunks(spark, str(tree / "in"), str(tree / "out"), glob, chunk_bytes=32)
    got = spark.read.parquet(str(tree / "out"))
    want = I._read_chunks(spark, str(tree / "in"), glob, 32).collect()
    rows = sorted((r.path, r.length, r.chunk, bytes(r.content)) for r in got.collect())
    assert rows and rows == sorted((r.path, r.length, r.chunk, bytes(r.content)) for r in want)
    assert got.schema.simpleString() == "struct<path:string,name:string,kind:string,length:bigint,chunk:bigint,content:binary>"


def test_no_reader_holds_the_files(spark, tree, monkeypatch):
    monkeypatch.setattr(I, "few_listings", lambda *_: pytest.fail("listed by the driver's readers"))
    I.land_chunks(spark, str(tree / "in"), str(tree / "out"), "*.txt", chunk_bytes=64)
    assert all(r.complete for r in I.file_digests(spark.read.parquet(str(tree / "out"))).collect())


def test_ranges_of_a_large_file_are_read_apart(spark, tree):
    data = random.Random(9).randbytes(5000)
    (tree / "large").mkdir()
    (tree / "large" / "f.bin").write_bytes(data)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"file:{tree / 'large'}")
    rows = I._file_chunks(spark, folder, "*", 300, range_bytes=1000).collect()
    assert [r.chunk for r in sorted(rows, key=lambda r: r.chunk)] == list(range(17)) and {r.path for r in rows} == {f"file:{tree / 'large' / 'f.bin'}"}
    assert b"".join(bytes(r.content) for r in sorted(rows, key=lambda r: r.chunk)) == data


def test_nothing_there(spark, tmp_path):
    (tmp_path / "in").mkdir()
    I.land_chunks(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        I.land_chunks(spark, str(tmp_path / "gone"), str(tmp_path / "out"))
