"""Large files in ranges: the same rows as whole, wherever the ranges are cut."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from scriptorium.sources import files as I
from scriptorium.sources.records import Entries, Quoted, records


@pytest.fixture(params=[1 << 30, 61, 17])
def ranges(spark, request):
    """Bytes of a range: everything at once, or cuts nearly everywhere."""
    names = {"spark.sql.files.maxPartitionBytes": str(request.param), "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield request.param
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def texts(n, seed=0):
    rng = random.Random(seed)
    return [(i, "".join(rng.choice(['a', 'é', ',', '"', '\n', ' ', 'bc', "'", '""', '\\']) for _ in range(rng.randint(0, 30)))) for i in range(n)]


def test_quoted_csv(spark, ranges, tmp_path):
    rows = texts(60)
    for name, part in (("a.csv", rows[:40]), ("b.csv", rows[40:]), ("empty.csv", [])):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_NONNUMERIC)
        writer.writerow(["n", "head\nline"])
        writer.writerows(part)
        (tmp_path / name).write_text(out.getvalue())
    schema = "n int, t string"
    assert rows_of(I.read_csv_ranges(spark, str(tmp_path), schema)) == rows_of(I.read_csv(spark, str(tmp_path), schema)) == sorted(rows, key=repr)


def test_plain_csv_with_stray_quotes(spark, ranges, tmp_path):
    text = 'n;t\r\n1;5" disk\r\n2;"a""b;\nc"\r\n\r\n3;\r\n4;""\r\n5;say "x"; y\r\n6;"open" tail\r\n7;last'
    (tmp_path / "x.csv").write_text(text, newline="")
    got = rows_of(I.read_csv_ranges(spark, str(tmp_path / "x.csv"), "n int, t string", ";"))
    assert got == [(1, '5" disk'), (2, 'a"b;\nc'), (3, None), (4, ""), (5, 'say "x"'), (6, '"open" tail'), (7, "last")]
    assert rows_of(I.read_csv(spark, str(tmp_path / "x.csv"), "n int, t string", ";")) == got


def test_an_open_quote_goes_to_the_end(spark, ranges, tmp_path):
    (tmp_path / "x.csv").write_text('h\n1\n"open\n2\n3\n')
    assert rows_of(records(spark, str(tmp_path), Quoted()).select("first", "text")) == [(False, '"open\n2\n3\n'), (False, "1"), (True, "h")]


def maps(n, seed=0):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice(['a', 'é', ',', '"', '\\', '{', '}', '[', ':', '\n', ' ', '😀', '\\"']) for _ in range(rng.randint(0, k)))
    return {f"{word(6)}#{i}": {"definition": rng.choice([None, word(30), "", "long " * 30])} for i in range(n)}


@pytest.mark.parametrize("indent", [None, 4])
def test_json_object(spark, ranges, tmp_path, indent):
    parts = [maps(25, 1), {f"x{k}": v for k, v in maps(20, 2).items()}, {}]
    for i, m in enumerate(parts):
        (tmp_path / f"{i}.json").write_text(json.dumps(m, ensure_ascii=bool(i), indent=indent))
    expected = sorted(((k, v["definition"]) for m in parts for k, v in m.items()), key=repr)
    assert rows_of(I.read_large_map(spark, str(tmp_path))) == expected == rows_of(I.read_trope_map(spark, str(tmp_path)))


def test_nested_values(spark, ranges, tmp_path):
    value = {"a": {"definition": "x", "more": [{"k": "}"}, [1, 2]], "n": 1.5}, "b,{": {"definition": None, "list": []}}
    (tmp_path / "x.json").write_text(json.dumps(value))
    found = [json.loads("{" + r.text + "}") for r in records(spark, str(tmp_path), Entries()).collect()]
    assert sorted(found, key=repr) == sorted(({k: v} for k, v in value.items()), key=repr)


def test_written_object(spark, tmp_path):
    rows = [("b", 'x "y"\n'), ("a", None), ("ä,{", ""), ("a", "z"), (None, "lost"), ("c\\", "}")]
    df = spark.createDataFrame(rows, "name string, definition string").repartition(4)
    path = str(tmp_path / "out" / "map.json")
    for _ in range(2):
        I.write_trope_map(df, path)
    written = json.loads(open(path, encoding="utf-8").read())
    assert list(written.items()) == [("a", {"definition": "z"}), ("b", {"definition": 'x "y"\n'}), ("c\\", {"definition": "}"}), ("ä,{", {"definition": ""})]
    assert rows_of(I.read_large_map(spark, path)) == [(k, v["definition"]) for k, v in written.items()]
    I.write_trope_map(df.limit(0), path)
    assert json.loads(open(path).read()) == {} and I.read_large_map(spark, path).count() == 0


def test_broken_entries_fail(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": {"definition": "x"}, "b": {"definition": 1 1}}')
    with pytest.raises(Exception):
        I.read_large_map(spark, str(tmp_path)).collect()
    assert I.read_large_map(spark, str(tmp_path)).select(F.lit(1)).schema is not None


def test_chunks_are_the_files(spark, ranges, tmp_path):
    rng = random.Random(4)
    source = tmp_path / "in"
    source.mkdir()
    contents = {"a.bin": rng.randbytes(700), "b b+c.txt": "é\nx\r\n".encode() * 30, "empty": b"", "n": b"\n", "nn": b"\n\n", "no end": b"x" * 150, "z.gz": rng.randbytes(200), "one.txt": b"1\n2"}
    for name, data in contents.items():
        (source / name).write_bytes(data)
    I.land_chunks(spark, str(source), str(tmp_path / "out"), chunk_bytes=64)
    chunks = spark.read.parquet(str(tmp_path / "out"))
    got = {}
    for r in chunks.orderBy("path", "chunk").collect():
        assert len(r.content) <= 64
        got.setdefault(r.path.rsplit("/", 1)[1].replace("%20", " "), []).append((r.chunk, bytes(r.content)))
    assert {n: b"".join(c for _, c in v) for n, v in got.items()} == {n: c for n, c in contents.items() if c}
    assert all([i for i, _ in v] == list(range(len(v))) for v in got.values())
    digests = I.file_digests(chunks).collect()
    assert len(digests) == len(contents) - 1 and all(r.complete for r in digests)


def test_one_object_is_written_by_all(spark, tmp_path, monkeypatch):
    """No step of the writing goes through one partition, and the bytes are those of one writer."""
    df = spark.createDataFrame([(f"n{i:03}", None if i % 7 == 0 else f"é {i}") for i in range(90, -1, -1)] + [("n001", "a"), (None, "x")], "name string, definition string").repartition(5)
    whole = {f"n{i:03}": {"definition": None if i % 7 == 0 else f"é {i}"} for i in range(91)}
    whole["n001"] = {"definition": "a"}
    lines = ",\n".join(json.dumps({k: v}, ensure_ascii=False, separators=(",", ":"))[1:-1] for k, v in whole.items())
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    monkeypatch.setattr(type(df), "coalesce", lambda *_: pytest.fail("one partition"))
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        path = str(tmp_path / "in" / "map.json")
        for _ in range(2):  # the second in place of the first
            I.write_trope_map(df, path)
            assert (tmp_path / "in" / "map.json").read_bytes() == f"{{\n{lines}\n}}\n".encode()
        assert sorted(p.name for p in (tmp_path / "in").iterdir()) == ["map.json"]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    assert {r.name: r.definition for r in I.read_large_map(spark, path).collect()} == {k: v["definition"] for k, v in whole.items()}


@pytest.mark.parametrize("piece", [1, 2, 5, 1000])
def test_pieces_are_put_where_they_belong(spark, tmp_path, piece):
    (tmp_path / "parts").mkdir()
    for i, text in enumerate(['"a":1,\n"bé":2,\n', "", '"c":3,\n']):
        (tmp_path / "parts" / f"part-{i:05}-x-c000.txt").write_text(text)
    assert I._join_parts(spark, str(tmp_path / "parts"), str(tmp_path / "out.json"), piece)
    assert (tmp_path / "out.json").read_text() == '{\n"a":1,\n"bé":2,\n"c":3\n}\n' and not (tmp_path / "parts").exists()
