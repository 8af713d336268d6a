"""Records of large files that no line end delimits: CSV with line breaks in quotes, one JSON object for a whole catalogue.

A file is read in byte ranges by Spark's text source, cut at a character that can be found anywhere (a line feed, a quotation mark). What a piece
means depends on all before it, so this takes two passes. The first works out for each range how it changes the reader's state, for every state it could be
entered with, and these maps are composed range by range. The second enters each range with its state and gives the records that
lie in it; what is left at its ends, two fragments at most, is joined to records afterwards. Neither pass shuffles the file.

The driver and each task hold a few words per range. A record has to fit a row. Compressed files are one range.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A record in one range, the rest of one that began before, one that is open at the end, a range that is inside of one record.
WHOLE, REST, OPEN, INSIDE = range(4)
_FOUND = pa.schema([("file", pa.string()), ("block", pa.int64()), ("number", pa.int64()), ("kind", pa.int32()), ("text", pa.string())])


def pieces(spark: SparkSession, path: str, cut: str) -> DataFrame:
    """``file``, ``block`` (where the range begins) and ``value``: what stands between two cuts, in order within a range."""
    return spark.read.option("lineSep", cut).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _ranges(batches: Iterator[pa.RecordBatch]):
    """Consecutive pieces of one range: its file and start, then the pieces; a range may come in several runs."""
    for b in batches:
        files, blocks, values = (b.column(i).to_pylist() for i in range(3))
        start = 0
        for i in range(1, b.num_rows + 1):
            if i == b.num_rows or blocks[i] != blocks[start] or files[i] != files[start]:
                yield (files[start], blocks[start]), values[start:i]
                start = i


class Quoted:
    """CSV: the state is whether a quoted field is open; a line that ends outside of one ends a record."""

    cut = "\n"
    begin = 0

    def __init__(self, sep: str = ","):
        self.sep = sep
        self.close = re.compile(r'(?:[^"]|"")*+"')

    def opens(self, line: str, inside: int) -> int:
        """Whether a field is open at the line's end. A quotation mark opens one at a field's beginning only, and two are a mark in it."""
        if '"' not in line:
            return inside
        at, size = 0, len(self.sep)
        while True:
            if inside or line.startswith('"', at):
                m = self.close.match(line, at + (not inside))
                if not m:
                    return 1
                at, inside = m.end(), 0
            at = line.find(self.sep, at)
            if at < 0:
                return 0
            at += size

    def start(self):
        return 0, 1

    def advance(self, states, lines: list[str]):
        for line in lines:
            if '"' in line:
                states = tuple(self.opens(line, s) for s in states)
        return states

    @staticmethod
    def summary(states) -> tuple[int, ...]:
        return states

    @staticmethod
    def compose(state: int, summary) -> int:
        return summary[state]

    def records(self, state: int, lines: list[str]):
        """``(text, ended)`` of each stretch, and the state behind the lines."""
        out, held = [], []
        for line in lines:
            state = self.opens(line, state)
            held.append(line)
            if not state:
                out.append(("\n".join(held).removesuffix("\r"), True))
                held = []
        if held:
            out.append(("\n".join(held) + "\n", False))
        return out, state


class Entries:
    """A JSON object: the state is twice the depth, plus one inside of a string. An entry ends at a comma or brace of the outermost level."""

    cut = '"'
    begin = 0
    _MARKS = re.compile(r"[{}\[\],]")
    _SLASHES = re.compile(r"\\+\Z")

    def _escaped(self, piece: str) -> bool:
        """Whether the quotation mark behind the piece belongs to the string."""
        m = self._SLASHES.search(piece) if piece.endswith("\\") else None
        return bool(m) and len(m[0]) % 2 == 1

    @staticmethod
    def _change(piece: str) -> int:
        return piece.count("{") + piece.count("[") - piece.count("}") - piece.count("]")

    def start(self):
        """In a string or not, and the change of depth so far, for both ways to begin."""
        return (0, 0), (1, 0)

    def advance(self, states, parts: list[str]):
        out = []
        for inside, depth in states:
            for p in parts:
                if inside:
                    inside = int(self._escaped(p))
                else:
                    depth += self._change(p)
                    inside = 1
            out.append((inside, depth))
        return tuple(out)

    @staticmethod
    def summary(states) -> tuple[int, ...]:
        return tuple(x for s in states for x in s)

    @staticmethod
    def compose(state: int, summary) -> int:
        inside, change = summary[2 * (state & 1):2 * (state & 1) + 2]
        return state // 2 * 2 + 2 * change + inside

    def records(self, state: int, parts: list[str]):
        out, held = [], []
        depth, inside = state >> 1, state & 1
        for p in parts:
            if inside:
                held.append(p)
                inside = int(self._escaped(p))
            else:
                at = 0
                for m in self._MARKS.finditer(p):
                    c, before = m[0], depth
                    depth += (c in "{[") - (c in "}]")
                    if min(before, depth) == 0 or (c == "," and depth == 1):  # outermost braces, and commas between entries
                        held.append(p[at:m.start()])
                        if before:
                            out.append(("".join(held), True))
                        held, at = [], m.end()
                held.append(p[at:])
                inside = 1
            if depth:
                held.append('"')
            else:
                held = []
        if held:
            out.append(("".join(held), False))
        return out, 2 * depth + inside


def _summaries(reader) -> Callable:
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("summary", pa.list_(pa.int64()))])

    def run(batches):
        at, states = None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([at[0]]), pa.array([at[1]], pa.int64()), pa.array([reader.summary(states)], pa.list_(pa.int64()))], schema=schema)

        for where, values in _ranges(batches):
            if where != at:
                if at:
                    yield row()
                at, states = where, reader.start()
            states = reader.advance(states, values)
        if at:
            yield row()
    return run


def _composed(reader) -> Callable:
    def run(ranges: pd.DataFrame) -> pd.DataFrame:
        ranges, state, states = ranges.sort_values("block"), reader.begin, []
        for s in ranges["summary"]:
            states.append(state)
            state = reader.compose(state, list(s))
        return pd.DataFrame({"file": ranges["file"], "block": ranges["block"], "state": states})
    return run


def _cut(reader, shared) -> Callable:
    def run(batches):
        at, state, number, began, held = None, 0, 0, True, []

        def tail():
            """What is open where a range ends."""
            text = "".join(held)
            held.clear()
            if text:
                yield _batch([(*at, number, OPEN if began else INSIDE, text)])

        for where, values in _ranges(batches):
            if where != at:
                if at:
                    yield from tail()
                # A range entered at rest begins with a record of its own.
                at, state, number = where, shared.value.get(where, reader.begin), 0
                began = state == reader.begin
            found, state = reader.records(state, values)
            rows = []
            for text, ended in found:
                held.append(text)
                if ended:
                    rows.append((*at, number, WHOLE if began else REST, "".join(held)))
                    held.clear()
                    number, began = number + 1, True
            if rows:
                yield _batch(rows)
        if at:
            yield from tail()
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _FOUND)], schema=_FOUND)


def records(spark: SparkSession, path: str, reader) -> DataFrame:
    """``file``, ``first`` (the first record of its file) and ``text`` of every record."""
    parts = pieces(spark, path, reader.cut)
    ranges = parts.mapInArrow(_summaries(reader), "file string, block long, summary array<long>")
    states = ranges.groupBy("file").applyInPandas(_composed(reader), "file string, block long, state long")
    entered = {(r.file, r.block): r.state for r in states.where(F.col("state") != reader.begin).toLocalIterator()}  # a few words a range
    found = parts.mapInArrow(_cut(reader, spark.sparkContext.broadcast(entered)), "file string, block long, number long, kind int, text string")
    whole = found.where(F.col("kind") == WHOLE).select("file", ((F.col("block") == 0) & (F.col("number") == 0)).alias("first"), "text")
    # Fragments: one that is open begins a record, those behind it go on with it.
    place = F.struct("block", F.when(F.col("kind") == OPEN, 1).otherwise(0).alias("late"))
    chain = F.sum((F.col("kind") == OPEN).cast("int")).over(Window.partitionBy("file").orderBy(place))
    joined = found.where(F.col("kind") != WHOLE).select("file", chain.alias("chain"), F.struct(place.alias("place"), "number", "text").alias("part")).groupBy("file", "chain").agg(
        F.sort_array(F.collect_list("part")).alias("parts"))
    head = F.get("parts", F.lit(0))
    return whole.unionByName(joined.select("file", ((head["place"]["block"] == 0) & (head["number"] == 0)).alias("first"), F.array_join("parts.text", "").alias("text")))
