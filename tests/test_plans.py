"""Files, and the workflows end to end on small literal data."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from scriptorium.plans import catalogue, overview, staging, tagging
from scriptorium.operators import writes as W
from scriptorium.operators.merge import keyed_update
from scriptorium.session import clear_stored, store, work_dir
from scriptorium.sources import files as I
from scriptorium.sources import tables as T


def test_csv_keeps_hard_text(spark, tmp_path):
    df = spark.createDataFrame([("None", 'say "hi", \\ ok\nnext\r\nline', 1), (" pad ", "", 2), (None, "é;x", None)], "a string, b string, n int")
    for sep in (",", ";"):
        path = str(tmp_path / f"csv{ord(sep)}")
        I.write_csv(df, path, sep=sep)
        I.write_csv(df, path, sep=sep, single_file=True)
        got = I.read_csv(spark, path, df.schema, sep=sep)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


def test_whole_text_and_html(spark, tmp_path):
    (tmp_path / "mr. x+1%é.txt").write_text("line 1\nline 2\n")
    (tmp_path / "other.md").write_text("no")
    (tmp_path / "page.htm").write_bytes("<p>café</p>".encode("iso-8859-1"))
    assert [tuple(r) for r in I.read_whole_text(spark, str(tmp_path), glob="*.txt").collect()] == [("mr. x+1%é", "line 1\nline 2\n")]
    assert I.read_html_files(spark, str(tmp_path)).collect()[0]["html"] == "<p>caf�</p>"
    assert I.read_html_files(spark, str(tmp_path), "ISO-8859-1").collect()[0]["html"] == "<p>café</p>"
    assert {tuple(r)[:4] for r in I.file_manifest(spark, str(tmp_path), "*.htm").collect()} == {("page.htm", "page", "htm", 11)}
    I.land_raw(spark, str(tmp_path), str(tmp_path / "raw"), "*.txt")
    raw = spark.read.parquet(str(tmp_path / "raw")).first()
    assert (raw["name"], raw["kind"], bytes(raw["content"]), raw["length"]) == ("mr. x+1%é", "txt", b"line 1\nline 2\n", 14)


def test_trope_maps(spark, tmp_path):
    (tmp_path / "tropes.json").write_text(json.dumps({"A": {"definition": "one\ntwo"}, "B": {"definition": None}}, indent=4))
    want = [("A", "one\ntwo"), ("B", None)]
    read = I.read_trope_map(spark, str(tmp_path / "tropes.json"))
    assert sorted(map(tuple, read.collect())) == want
    I.write_trope_lines(read, str(tmp_path / "out"))
    assert sorted(map(tuple, I.read_trope_lines(spark, str(tmp_path / "out")).collect())) == want


def test_stored_tables_go_to_the_shared_folder(spark):
    assert work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert store(spark.range(3), "ids").count() == 3


def test_create_if_absent(spark):
    assert T.create_if_absent(spark, "movies", T.MOVIES)
    assert not T.create_if_absent(spark, "movies", T.MOVIES)
    assert spark.table("movies").schema.fieldNames() == T.MOVIES.fieldNames()
    spark.sql("DROP TABLE movies")


def test_catalogue(spark):
    first = spark.createDataFrame([("Alien: part II", "a.pdf"), ("Heat", None)], "name string, url string")
    second = spark.createDataFrame([("Alien - Part 2", "a.html"), ("Big_fish", "b.html"), ("heat", "h.html")], "name string, url string")
    merged = catalogue.merged_catalogue(first, second, "w/")
    assert sorted(map(tuple, merged.collect()), key=repr) == sorted([
        ("Alien Part 2", "a.pdf", "pdf", "alien_part_2.pdf", "Alien_Part_2", "w/Alien_Part_2"),
        ("Big Fish", "b.html", "html", "big_fish.html", "Big_Fish", "w/Big_Fish"),
        ("Heat", None, "pdf", "heat.pdf", "Heat", "w/Heat")], key=repr)
    pages = spark.createDataFrame([("w/Alien_Part_2", "<p>yes</p>"), ("w/Heat", "<p>nothing here</p>")], "url_wiki string, html string")
    scripts, wiki = catalogue.ingest_lists(catalogue.checked_catalogue(merged, pages, "nothing here"))
    assert [tuple(r) for r in scripts.collect()] == [("Alien Part 2", "a.pdf", "pdf", "alien_part_2.pdf")]
    assert [tuple(r) for r in wiki.collect()] == [("Alien Part 2", "alien_part_2.pdf", "w/Alien_Part_2", True)]


SCRIPT = "ALL SCRIPTS\n<pre>Intro words here\nINT. SHIP - DAY\nalien hunts crew\nEXT. PLANET\nstorm rises</pre>"


def test_scripts_to_tags(spark):
    html = spark.createDataFrame([("alien", SCRIPT), ("both", "<p>from html</p>")], "name string, html string")
    pdf = spark.createDataFrame([("both", 2, "INT. B\nend"), ("both", 1, "start")], "name string, page int, text string")
    movies = staging.movies(staging.staged_scripts(html, pdf))
    assert movies.schema.fieldNames() == T.MOVIES.fieldNames()
    assert {r["name"]: r["scenes"] for r in movies.collect()} == {
        "alien": ["Intro words here", "INT. SHIP - DAY\nalien hunts crew", "EXT. PLANET\nstorm rises"],
        "both": ["start", "INT. B\nend"]}

    concepts = spark.createDataFrame([("Hunt", "old text", 1), ("Hunt", "alien hunts crew int. ship - day", 2), ("Storm", "ext. planet storm rises", 1),
                                      ("Undefined", None, 1), ("Start", "start", 1)], "name string, definition string, o int")
    vectors = tagging.concept_vectors(concepts, "name", "definition", "o")
    assert {r["item_id"] for r in vectors.collect()} == {"Hunt", "Storm", "Start"}
    tagged = tagging.tag_documents(movies, vectors, "name", "full_script", k=1)
    tags = {r["name"]: r["tropes"] for r in tagged.collect()}
    assert {"Hunt", "Storm"} <= set(tags["alien"]) and "Start" in tags["both"]
    assert tagged.count() == 2


def test_untagged_documents_stay(spark):
    docs = spark.createDataFrame([("a", None), ("b", "x")], "name string, text string")
    vectors = tagging.concept_vectors(spark.createDataFrame([("C", "x")], "name string, definition string"), "name", "definition")
    got = {r["name"]: r["tropes"] for r in tagging.tag_documents(docs, vectors, "name", "text").collect()}
    assert got == {"a": [], "b": ["C"]}


def test_overview(spark):
    movies = spark.createDataFrame([("m", "one two", ["b", " A ", ""]), ("n", "x", ["b"]), ("o", None, None)],
                                   "name string, full_script string, tropes array<string>")
    assert tuple(overview.figures(movies).first()) == (3, 3, 1, 2, "m")
    assert [tuple(r) for r in overview.frequent_tropes(movies).orderBy("rank").collect()] == [("b", 2, 1), ("A", 1, 2)]
    assert tuple(overview.movie_card(movies, "m").first()) == ("m", 2, "one two", ["A", "b"])
    assert tuple(overview.similar_movie(movies, "n").first()) == ("m", 1 / 3)
    assert [r[0] for r in overview.movies_with_trope(movies, "b").orderBy("name").collect()] == ["m", "n"]
    with pytest.raises(ValueError):
        overview.similar_movie(movies, "none such")


def test_update_scenes_and_tropes(spark):
    movies = spark.createDataFrame([("m", None), ("n", ["old"])], "name string, tropes array<string>")
    new = spark.createDataFrame([("m", ["x"])], "name string, tropes array<string>")
    assert {r["name"]: r["tropes"] for r in keyed_update(movies, new, "name", "tropes").collect()} == {"m": ["x"], "n": ["old"]}


def test_written_tables(spark):
    first = spark.createDataFrame([("a", 1), ("b", None), ("b", 2)], "k string, v int")
    assert [W.append_keyed(spark, "kept", first, "k", 4) for _ in range(2)] == [2, 0]
    more = spark.table("kept").select("k", "v").unionByName(spark.createDataFrame([("c", 3)], "k string, v int"))
    assert W.append_keyed(spark, "kept", more, "k", 4) == 1
    for _ in range(2):
        new = spark.table("kept").select("k", (F.length("k") * 10).alias("v")).where("k <> 'c'").unionByName(spark.createDataFrame([("z", 9)], "k string, v int"))
        assert [tuple(r) for r in W.update_keyed(spark, "kept", new, "k", "v", 4).collect()] == [("z", 9)]
    assert sorted(tuple(r) for r in spark.table("kept").select("k", "v").collect()) == [("a", 10), ("b", 10), ("c", 3)]
    spark.sql("DROP TABLE kept")


def test_json_rejects(spark, tmp_path):
    texts = ['{"k": 3000000000}', '{"k": 1.5, "m": 2}', '{"k": 7}', '{"k": null}', "[1]", "{broken", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert sorted(tuple(r) for r in I.map_rows(df, "t", "map<string,int>", "i").collect()) == [(1, "m", 2), (2, "k", 7), (3, "k", None)]
    assert {(r.i, r.map_key, r.reason) for r in I.map_rejects(df, "t", "map<string,int>", "i").collect()} == {
        (0, "k", "value"), (1, "k", "value"), (4, None, "object"), (5, None, "object")}
    (tmp_path / "broken.json").write_text('{"A": {"definition": "x"')
    with pytest.raises(Exception):
        I.read_trope_map(spark, str(tmp_path / "broken.json")).collect()


def test_stored_tables_can_be_cleared(spark):
    store(spark.range(3), "ids")
    assert clear_stored(spark) >= 1 and clear_stored(spark) == 0


def test_unknown_movie(spark):
    movies = spark.createDataFrame([("m", "one two", ["b"])], "name string, full_script string, tropes array<string>")
    with pytest.raises(ValueError):
        overview.movie_card(movies, "none such")


def test_retagging_gives_what_tagging_gives(spark):
    concepts = store(tagging.concept_vectors(spark.createDataFrame([("c1", "a storm at sea"), ("c2", "the cat sleeps"), ("c3", "storm and cat")], "n string, d string"), "n", "d"), "concepts")
    texts = {"m": "a cat\nINT. HOUSE\nthe cat sleeps", "n": "a storm\nINT. HOUSE\nthe cat sleeps", "e": "", "z": None}
    tables = {"vectors": f"v_{uuid.uuid4().hex}", "tags": f"t_{uuid.uuid4().hex}"}

    def run(rows):
        docs = spark.createDataFrame([*rows.items(), (None, "lost")], "name string, full_script string")
        did = tagging.retag_documents(spark, docs, concepts, "name", "full_script", k=1, **tables)
        got = {r.name: r.tropes for r in W.keyed_rows(spark, tables["tags"]).collect()}
        want = {r.name: r.tropes or [] for r in tagging.tag_documents(docs, concepts, "name", "full_script", k=1).collect() if r.name}
        assert got == want
        return did

    first = run(texts)
    assert first["documents"] == 4 and run(texts) == {"documents": 0, "encoded": 0}
    assert run(texts | {"n": "a cat\nINT. HOUSE\na new scene", "q": "a cat"}) == {"documents": 2, "encoded": 1}
    for t in tables.values():
        spark.sql(f"DROP TABLE {t}")
