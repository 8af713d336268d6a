"""Readers and writers for the file formats at the edges.

Between stages everything is Parquet; CSV, text and JSON appear where data enters or leaves.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Sequence
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from scriptorium.functions.text import base_name, strip
from scriptorium.session import few_listings, store, work_dir
from scriptorium.sources.records import Entries, Quoted, records

TROPE_MAP = "map<string,struct<definition:string>>"
#: Folder of rows without a partition value, and the letters that such a folder's name can't have.
NO_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_ODD = re.compile(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""")


def read_csv(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",",
             multi_line: bool = True) -> DataFrame:
    """CSV with a declared schema. Line breaks, quotes and empty texts are read back exactly.

    Files whose texts have no line breaks can be read with ``multi_line=False``, which lets Spark
    cut large files into several tasks; ``read_csv_ranges`` does so for any. An empty field is null, a quoted empty field is an empty text; the reader marks the latter
    with a random word, as no fixed one can be ruled out in a text.
    """
    mark = uuid.uuid4().hex
    df = spark.read.schema(schema).options(header=True, encoding="UTF-8", multiLine=multi_line, **_csv_options(sep, mark)).csv(path)
    return _unmarked(df, mark)


def _csv_options(sep: str, mark: str) -> dict:
    return {"sep": sep, "quote": '"', "escape": '"', "emptyValue": mark, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _unmarked(df: DataFrame, mark: str) -> DataFrame:
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.select(*[F.when(F.col(c) != mark, F.col(c)).when(F.col(c).isNotNull(), F.lit("")).alias(c) if c in texts else F.col(c)
                       for c in df.columns])


def read_csv_ranges(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",") -> DataFrame:
    """What ``read_csv`` reads, with every large file read by several tasks, line breaks in quotes or not.

    Line breaks in quotes are kept as they are; blank lines between records are passed over.
    """
    mark = uuid.uuid4().hex
    found = records(spark, path, Quoted(sep)).where(~F.col("first") & (F.col("text") != ""))
    ddl = schema if isinstance(schema, str) else schema.toDDL()
    row = F.from_csv("text", F.lit(ddl), {**_csv_options(sep, mark), "maxCharsPerColumn": "-1"})
    return _unmarked(found.select(row.alias("row")).select("row.*"), mark)


def write_csv(df: DataFrame, path: str, sep: str = ",", single_file: bool = False, file_bytes: int | None = None) -> None:
    """CSV with a header. ``single_file`` gives up all parallelism; it is for small exports. With ``file_bytes`` there are as many files as hold about so
    much text each, one for a table of less; its text is measured first.
    """
    files = 1 if single_file else None
    if file_bytes:
        length = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 1 for c in df.columns), F.lit(0).cast("bigint"))
        files = max(1, -(-(df.agg(F.sum(length)).first()[0] or 0) // file_bytes))
    out = df.coalesce(files) if files else df
    (
        out.write.mode("overwrite")
        .option("header", True).option("sep", sep).option("encoding", "UTF-8")
        .option("quote", '"').option("escape", '"').option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_whole_text(spark: SparkSession, path: str, name: Column | None = None, glob: str | None = None, nested: bool = False) -> DataFrame:
    """One row ``(name, text)`` per file; the name is the file name without its last extension. ``nested`` reads the files of all folders below as well."""
    reader = spark.read.option("recursiveFileLookup", nested)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    # The metadata column holds names percent-encoded, with plus signs left as they are.
    source = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    with few_listings(spark):
        files = reader.text(path, wholetext=True)
    return files.select((base_name(source) if name is None else name).alias("name"), F.col("value").alias("text"))


def read_html_files(spark: SparkSession, path: str, charset: str = "UTF-8", glob: str = "*.htm*", nested: bool = False) -> DataFrame:
    """One row ``(name, html)`` per file. Bytes that are not valid in ``charset`` are replaced.

    ``nested`` reads the files of all folders below without taking those for partitions, which Spark's planner would hold and look through one by one.
    """
    content = F.col("content")
    decoded = content.cast("string") if charset.upper() == "UTF-8" else F.decode(content, charset)
    if charset.upper() == "UTF-8":
        decoded = F.make_valid_utf8(decoded)
    with few_listings(spark):
        files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", nested).load(path)
    return files.select(base_name(F.col("path")).alias("name"), decoded.alias("html"))


def file_manifest(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Inventory of files; the contents are not read."""
    with few_listings(spark):
        files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return files.select(
        F.regexp_replace("path", r"^.*/", "").alias("file_name"),
        base_name(F.col("path")).alias("name"),
        F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).alias("kind"),
        F.col("length"),
        F.col("modificationTime").alias("modified"),
    )


def land_raw(spark: SparkSession, source: str, target: str, glob: str = "*") -> None:
    """Copy files into a Parquet table ``raw(path, name, kind, content, length)``."""
    with few_listings(spark):
        files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(source)
    files.select(
        "path", base_name(F.col("path")).alias("name"),
        F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).alias("kind"), "content", "length",
    ).write.mode("overwrite").parquet(target)


def land_chunks(spark: SparkSession, source: str, target: str, glob: str = "*", chunk_bytes: int = 8 << 20) -> None:
    """Copy files of any size into a Parquet table ``(path, name, kind, length, chunk, content)``, at most ``chunk_bytes`` a row.

    Chunks are numbered from 0 in order. Files without bytes have no row. A folder on a local or mounted file system is listed and read by tasks, in byte ranges
    of whole chunks, so the driver holds no file's name and millions of files are no more to it than one; other stores and paths with wildcards go through Spark's
    readers (``_read_chunks``), whose driver holds every file. Both pass over names that begin with a dot or an underscore, as those readers do.
    ``file_digests`` checks what has landed.
    """
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = at(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    direct = fs.getUri().getScheme() == "file" and not set(source) & set("{}[]*?\\") and fs.exists(at(source)) and fs.getFileStatus(at(source)).isDirectory()
    chunks = _file_chunks(spark, fs.makeQualified(at(source)), glob, chunk_bytes) if direct else _read_chunks(spark, source, glob, chunk_bytes)
    chunks.select("path", base_name(F.col("path")).alias("name"), F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).alias("kind"), "length", "chunk", "content").write.mode(
        "overwrite").parquet(target)


def _file_chunks(spark: SparkSession, folder, glob: str, chunk_bytes: int, range_bytes: int = 64 << 20, open_bytes: int = 16 << 10) -> DataFrame:
    """``(path, length, chunk, content)`` of the files below a qualified path of a local or mounted file system.

    One task lists the folder's own names, all tasks what is below them, and the list is stored. A range has about ``range_bytes``; a task has as many bytes,
    of small files fewer, as ``open_bytes`` are added for each.
    """
    context = spark.sparkContext
    root, shown = folder.toUri().getPath().rstrip("/"), folder.toString().rstrip("/")
    wanted = re.compile(context._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().toString(), re.DOTALL)
    range_bytes = max(1, range_bytes // chunk_bytes) * chunk_bytes

    def names(batches):
        for _ in batches:
            with os.scandir(root or "/") as found:
                while some := [e.name for e in islice(found, 10_000)]:
                    yield pa.RecordBatch.from_pydict({"name": pa.array(some, pa.string())})

    def below(path):
        name, folder = os.path.basename(path), os.path.isdir(path)
        if name.endswith("._COPYING_") or name.startswith(".") or name.startswith("_") and "=" not in name and not (folder and name.startswith(("_metadata", "_common_metadata"))):
            return
        if folder:
            with os.scandir(path) as found:
                for e in found:
                    yield from below(e.path)
        elif wanted.fullmatch(name) and os.path.exists(path):
            yield path, os.path.getsize(path)

    def listed(batches):
        for b in batches:
            found = (x for name in b.column(0).to_pylist() for x in below(f"{root}/{name}"))
            while some := [*islice(found, 10_000)]:
                yield pa.RecordBatch.from_pydict({"file": pa.array([x for x, _ in some], pa.string()), "length": pa.array([n for _, n in some], pa.int64())})

    def read(batches):
        rows, held = [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.binary()))], names=["path", "length", "chunk", "content"])

        for b in batches:
            for file, length, start in zip(*(c.to_pylist() for c in b.columns)):
                with open(file, "rb") as f:
                    f.seek(start)
                    for at in range(start, min(start + range_bytes, length), chunk_bytes):
                        if content := f.read(min(chunk_bytes, length - at)):
                            rows.append((shown + file[len(root):], length, at // chunk_bytes, content))
                            held += len(content)
                        if held >= 8 << 20 or len(rows) >= 10_000:
                            yield batch()
                            rows, held = [], 0
        if rows:
            yield batch()

    tasks = 4 * context.defaultParallelism
    found = spark.range(0, 1, 1, 1).mapInArrow(names, "name string").repartition(tasks)
    files = store(found.mapInArrow(listed, "file string, length long").where("length > 0"), "files")
    n, length = files.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(range_bytes).cast("bigint")))
    tasks = max(1, min(n + length // range_bytes, max(tasks, -(-(length + n * open_bytes) // range_bytes))))
    return files.select("file", "length", starts.alias("start")).repartition(tasks).mapInArrow(read, "path string, length long, chunk long, content binary")


def _read_chunks(spark: SparkSession, source: str, glob: str, chunk_bytes: int) -> DataFrame:
    """The same rows by Spark's readers, for any store.

    Files are read in byte ranges by all cores, as text cut at line feeds, whose bytes are not looked at; the cuts are put back, and the last one of a file by
    its length. Files without bytes are passed over by Spark's readers. Spark would unpack files with the ending of a codec, so those are landed as a whole and cut then.
    """
    packed = F.lower("path").rlike(r"\.(gz|gzip|bz2|zst|lz4|snappy|deflate|xz)$")
    found = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    where = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    with few_listings(spark):
        text = found.option("lineSep", "\n").text(source)
        binary = found.format("binaryFile").load(source)  # listed once for both uses
    files = store(binary.select("path", "length", packed.alias("packed")), "files")
    lines = text.select(where.alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("content"))
    schema = pa.schema([("path", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("content", pa.binary())])

    def chunks(batches):
        at, n, held = None, 0, bytearray()

        def cut(least: int):
            nonlocal n
            while len(held) >= max(least, 1):
                yield pa.RecordBatch.from_arrays([pa.array([at[0]]), pa.array([at[1]], pa.int64()), pa.array([n], pa.int64()), pa.array([bytes(held[:chunk_bytes])], pa.binary())], schema=schema)
                del held[:chunk_bytes]
                n += 1

        for b in batches:
            for path, block, content in zip(*(b.column(i) for i in range(3))):
                if (path.as_py(), block.as_py()) != at:
                    yield from cut(1)
                    at, n = (path.as_py(), block.as_py()), 0
                held += content.as_py()
                held += b"\n"
                yield from cut(chunk_bytes)
        yield from cut(1)

    made = store(lines.where(~packed).mapInArrow(chunks, "path string, block long, n long, content binary"), "chunks")
    sizes = made.groupBy("path", "block").agg(F.count("*").alias("count"), F.sum(F.octet_length("content")).alias("bytes"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")  # a row a range
    bases = sizes.select("path", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"), F.sum("count").over(whole).alias("chunks"), F.sum("bytes").over(whole).alias("bytes"))
    numbered = made.join(bases, ["path", "block"]).join(files.where("not packed").select("path", "length"), "path").withColumn("chunk", F.col("base") + F.col("n"))
    # A last line without an end has got one: the file is a byte shorter.
    short = (F.col("chunk") == F.col("chunks") - 1) & (F.col("bytes") > F.col("length"))
    trimmed = F.when(short, F.substring("content", F.lit(1), F.octet_length("content") - 1)).otherwise(F.col("content"))
    kept = numbered.select("path", "length", "chunk", trimmed.alias("content")).where("octet_length(content) > 0")
    rest = binary.where(packed & (F.col("length") > 0))
    parts = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("length") - 1) / chunk_bytes))
    rest = rest.select("path", "length", "content", F.explode(parts).alias("chunk")).select(
        "path", "length", "chunk", F.substring("content", (F.col("chunk") * chunk_bytes + 1).cast("int"), F.lit(chunk_bytes)).alias("content"))
    return kept.unionByName(rest)


def file_digests(chunks: DataFrame) -> DataFrame:
    """``(path, length, n_chunks, complete, digest)`` of landed files: the digest is the SHA-256 of the chunks' SHA-256 digests in order, so no file is put together."""
    each = chunks.select("path", "length", F.struct("chunk", F.sha2("content", 256).alias("sha"), F.octet_length("content").cast("bigint").alias("n")).alias("c"))
    files = each.groupBy("path", "length").agg(F.sort_array(F.collect_list("c")).alias("cs"))
    size = F.aggregate("cs", F.lit(0).cast("bigint"), lambda a, c: a + c["n"])
    return files.select("path", "length", F.size("cs").cast("bigint").alias("n_chunks"), (size == F.col("length")).alias("complete"), F.sha2(F.array_join("cs.sha", ""), 256).alias("digest"))


def map_rows(df: DataFrame, column: str, schema: str, *keep: str) -> DataFrame:
    """One row ``(keep..., map_key, map_value)`` per entry of a JSON object held as text.

    Entries that can't be read as ``schema`` are not here; ``map_rejects`` has them.
    """
    entries, value = _entries(df, column, schema, keep)
    return entries.where(F.col("map_key").isNotNull() & (F.col("_raw").isNull() | value.isNotNull())).select(*keep, "map_key", value.alias("map_value"))


def map_rejects(df: DataFrame, column: str, schema: str, *keep: str) -> DataFrame:
    """What ``map_rows`` leaves out: ``(keep..., map_key, value, reason)``.

    ``object``: the text is no JSON object (key and value are null, the text is in ``value``). ``value``: an entry does not have the
    type asked for.
    """
    entries, value = _entries(df, column, schema, keep)
    broken = F.col("_text").isNotNull() & F.col("_map").isNull()
    odd = F.col("_raw").isNotNull() & value.isNull()
    return entries.where(broken | odd).select(
        *keep, "map_key", F.when(broken, F.col("_text")).otherwise(F.col("_raw")).alias("value"), F.when(broken, "object").otherwise("value").alias("reason"))


def _entries(df: DataFrame, column: str, schema: str, keep: Sequence[str]):
    """Entries with their values as text, and the expression that reads a value."""
    kind = schema[schema.index(",") + 1:schema.rindex(">")].strip()
    rows = df.select(*keep, F.col(column).alias("_text"), F.from_json(column, "map<string,string>").alias("_map"))
    rows = rows.select(*keep, "_text", "_map", F.explode_outer("_map").alias("map_key", "_raw"))
    value = F.from_json("_raw", kind) if kind.startswith(("struct", "map", "array")) else F.col("_raw").try_cast(kind)
    return rows, value


def _tropes(rows: DataFrame) -> DataFrame:
    """``(name, definition)`` of texts in ``value``; text that is not of this form fails, as a catalogue must not come in halves."""
    parsed = F.explode(F.from_json("value", TROPE_MAP, {"mode": "FAILFAST"})).alias("name", "entry")
    return rows.select(parsed).select("name", F.col("entry.definition").alias("definition"))


def read_trope_map(spark: SparkSession, path: str) -> DataFrame:
    """``(name, definition)`` from files that hold one object ``{name: {"definition": text}}``; a broken file fails."""
    return _tropes(spark.read.text(path, wholetext=True))


def read_large_map(spark: SparkSession, path: str) -> DataFrame:
    """The same from objects of any size: a file is cut into its entries by all cores, and an entry is a row."""
    entry = records(spark, path, Entries()).where(F.trim(F.translate("text", "\n\r\t", "   ")) != "")
    return _tropes(entry.select(F.concat(F.lit("{"), "text", F.lit("}")).alias("value")))


def write_trope_map(tropes: DataFrame, path: str) -> None:
    """One file that holds one object ``{name: {"definition": text}}``, in the order of the names.

    Names are sorted by all tasks, which write a file each. On a local or mounted file system tasks then copy ranges of these to their places in the one file;
    in other stores one task writes it, row by row. A repeated name keeps its smallest definition, a null name is left out.
    """
    spark = tropes.sparkSession
    rows = tropes.where("name is not null").groupBy("name").agg(F.min("definition").alias("definition"))
    entry = F.to_json(F.create_map("name", F.struct("definition")), {"ignoreNullFields": "false"})
    entries = rows.orderBy("name").select(entry.alias("e")).select(F.expr("substring(e, 2, length(e) - 2)").alias("value"))

    def framed(batches):
        """The entries between braces, each with a comma but the last, which is known once there is no other."""
        held = "{"
        for b in batches:
            texts = b.column(0).to_pylist()
            if texts:
                lines = [held, *(t + "," for t in texts[:-1])]
                held = texts[-1]
                if lines[0] != "{":
                    lines[0] += ","
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array([held, "}"], pa.string())], names=["value"])

    folder = work_dir(spark, "object")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    if all(at(p).getFileSystem(conf).getUri().getScheme() == "file" for p in (folder, path)):
        entries.select(F.concat("value", F.lit(","))).write.text(folder)
        if _join_parts(spark, folder, path):
            return
        folder = work_dir(spark, "object")
    lines = entries.coalesce(1).mapInArrow(framed, "value string")
    if rows.isEmpty():  # no rows, no task to frame them
        lines = spark.createDataFrame([("{}",)], "value string").coalesce(1)
    lines.write.text(folder)
    _move_only_part(spark, folder, path)


def _join_parts(spark: SparkSession, folder: str, path: str, piece_bytes: int = 64 << 20) -> bool:
    """Put the lines of a written folder, each ending with a comma, between braces at ``path``, in place of what is there; False if there are none.

    A task copies ``piece_bytes`` at most. The file gets its name when it is whole. The folder is deleted.
    """
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = jvm.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [(f.getPath().getName(), f.getLen()) for f in fs.listStatus(jvm.Path(folder)) if f.getPath().getName().startswith("part-")]
    found.sort(key=lambda f: (int(f[0].split("-")[1]), len(f[0]), f[0]))
    local = lambda p: fs.makeQualified(p).toUri().getPath()
    source, target = local(jvm.Path(folder)), jvm.Path(path)
    whole = jvm.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    own, end = local(whole), sum(n for _, n in found)  # two bytes in front; the last comma and line end are not copied
    if not end:
        fs.delete(jvm.Path(folder), True)
        return False
    pieces, place = [], 2
    for name, n in found:
        pieces += [(f"{source}/{name}", a, min(piece_bytes, n - a, end - place - a), place + a) for a in range(0, n, piece_bytes)]
        place += n

    def copy(piece):
        name, start, left, to = piece
        with open(name, "rb") as f, open(os.open(own, os.O_WRONLY | os.O_CREAT, 0o666), "wb") as out:
            f.seek(start)
            out.seek(to)
            while left > 0:
                got = f.read(min(left, 1 << 20))
                if not got:
                    raise OSError(f"{name} has become shorter")
                out.write(got)
                left -= len(got)

    fs.mkdirs(target.getParent())
    spark.sparkContext.parallelize(pieces, len(pieces)).foreach(copy)
    with open(os.open(own, os.O_WRONLY | os.O_CREAT, 0o666), "wb") as out:
        out.write(b"{\n")
        out.seek(end)
        out.write(b"\n}\n")
    fs.delete(target, True)
    if not fs.rename(whole, target):
        raise OSError(f"can't write {path}")
    fs.delete(jvm.Path(folder), True)
    return True


def _move_only_part(spark: SparkSession, folder: str, path: str) -> None:
    """Put the one file of a written folder at ``path``, in place of what is there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = at(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part = next(f.getPath() for f in fs.listStatus(at(folder)) if f.getPath().getName().startswith("part-"))
    fs.mkdirs(at(path).getParent())
    fs.delete(at(path), True)
    if not fs.rename(part, at(path)):
        raise OSError(f"can't write {path}")
    fs.delete(at(folder), True)


def write_trope_lines(tropes: DataFrame, path: str) -> None:
    """One object ``{name: {"definition": text}}`` per line; missing definitions stay as null."""
    entry = F.create_map(F.col("name"), F.struct(F.col("definition")))
    line = F.to_json(entry, {"ignoreNullFields": "false"})
    tropes.select(line.alias("value")).write.mode("overwrite").text(path)


def read_trope_lines(spark: SparkSession, path: str) -> DataFrame:
    return _tropes(spark.read.text(path))


def write_scripts(df: DataFrame, key: str, text: str, path: str) -> None:
    """One text file per key, in a folder ``key=value``: the stripped text and a line end.

    For handing scripts to other programs; within the library they stay rows of a table.
    """
    write_keyed_texts(df.select(key, strip(F.col(text)).alias("value")), key, "value", path)


def write_keyed_texts(df: DataFrame, key: str, text: str, path: str) -> None:
    """One text file per key, in a folder ``key=value``: its rows as lines. What is at ``path`` is replaced.

    Folders, names and bytes are those of Spark's partitioned text writer, which does the work in other stores. On a local or mounted file system
    Hadoop starts processes to set the permissions of every folder and file, so tasks write there themselves: under a hidden name first, so a repeated task
    puts the same file in place of its own. ``_SUCCESS`` comes last.
    """
    spark = df.sparkSession
    rows = df.select(key, text).repartition(F.col(key))
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target = at(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() != "file":
        rows.write.mode("overwrite").partitionBy(key).text(path)
        return
    root, name = fs.makeQualified(target).toUri().getPath(), f"part-00000-{uuid.uuid4()}.c000.txt"
    fs.delete(target, True)
    fs.mkdirs(target)

    def write(batches):
        n, own, out, folder = 0, f".{name}-{uuid.uuid4().hex}", None, None

        def close():
            if out:
                out.close()
                os.replace(os.path.join(folder, own), os.path.join(folder, name))

        for b in batches:
            for value, line in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                now = os.path.join(root, _partition_folder(key, value))
                if now != folder:
                    close()
                    os.makedirs(now, exist_ok=True)
                    out, folder, n = open(os.path.join(now, own), "wb"), now, n + 1
                out.write((line or b"") + b"\n")
        close()
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    value = F.coalesce(F.nullif(F.col(key).cast("string"), F.lit("")), F.lit(NO_PARTITION))
    placed = df.select(value.alias("key"), F.col(text).alias("value")).repartition("key").sortWithinPartitions("key")
    placed.mapInArrow(write, "n long").agg(F.sum("n")).collect()
    fs.create(at(path, "_SUCCESS"), True).close()


def _partition_folder(name: str, value: str) -> str:
    """``name=value`` with the letters escaped that Spark escapes in folders of partitions."""
    return "=".join(_ODD.sub(lambda c: f"%{ord(c[0]):02X}", part) for part in (name, value))
