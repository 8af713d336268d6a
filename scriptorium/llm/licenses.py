"""License scan by diagonal voting.

1. Every text is cut into words; the hashes of all its runs of ``k`` words are joined with the places of the templates' runs (a few thousand rows,
   checked against ``MOST`` and broadcast, so that a very frequent run is not dealt to one task).
2. A hit at text place ``i`` and template place ``j`` votes for the diagonal ``i - j``: one aligned occurrence. Votes are counted by text, template and diagonal.
3. Neighbouring diagonals of a template (at most ``GAP`` words apart: a word was put in or left out) are merged, and merged ones with too few votes dropped.
4. What is left is verified on the words themselves: the longest common subsequence of the span and the template. Exact templates, the base phrases,
   need all their words in a row. Of overlapping spans of other templates the most similar one counts.

``score`` is the highest share of a template's words in a verified span; a base phrase, which only mentions a license, counts half.

Null and empty texts have no words, no places and score 0. Rows are judged by their own text: repeated rows and ids give repeated rows, a null id is kept.
Very long texts are hashed in blocks; hits and spans of one text go to one task, as the text does. Equal starts: smaller template. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from scriptorium.llm.anchors import keyed
from scriptorium.llm.common import Hashes, IdFilter, bounds, grams, holding, mix, skipping, slices, store, to_batch

#: Words of a block, words between diagonals that are merged, most places of templates in the broadcast index.
BLOCK, GAP, MOST = 1 << 16, 4, 1_000_000
#: Words in a row for texts and for base phrases.
RUN, PHRASE_RUN = 3, 2
#: A-Z in lower case; every other byte that is no part of a word as a blank.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

# The base phrases and their labels.
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))
# Published license texts and the usual lines that grant them.
TEXTS = (
    ("mit-grant", "Released under the MIT License"),
    ("mit-grant", "Licensed under the MIT License"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
                 "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
                 "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
                 "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("isc-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
                 "copyright notice and this permission notice appear in all copies."),
    ("bsd-text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
                 "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
                 "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
                 "and/or other materials provided with the distribution."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                   "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass(frozen=True)
class Template:
    """``run`` words make a hit; an ``exact`` template has to stand there word by word."""

    label: str
    words: tuple[bytes, ...]
    run: int
    exact: bool

    @property
    def votes(self) -> int:
        """Votes that a span needs to be looked at."""
        n = len(self.words) - self.run + 1
        return n if self.exact else max(1, min(n // 4, 20))


def templates(phrases=PHRASES, texts=TEXTS) -> list[Template]:
    """Templates shorter than a run of words use their own length as run."""
    return [Template(label, tuple(w), min(len(w), PHRASE_RUN if exact else RUN), exact)
            for exact, group in ((True, phrases), (False, texts)) for label, text in group if (w := words_of(text.encode()))]


def _runs(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words, other ones for every ``k``."""
    return grams(h, k) ^ mix(np.array([k], np.uint64))


def _index(spark, known: list[Template]) -> DataFrame:
    hashes, rows = Hashes(), []
    for t, x in enumerate(known):
        rows += [(int(g), t, j, x.exact, x.votes) for j, g in enumerate(_runs(hashes.of(list(x.words)), x.run).view(np.int64))]
    if len(rows) > MOST:
        raise ValueError(f"templates have {len(rows)} places, more than {MOST}")
    return F.broadcast(spark.createDataFrame(rows, "gram long, template int, place long, exact boolean, votes int"))


def _hashed(ks: list[int]):
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("first", pa.int64()), ("grams", pa.list_(pa.int64()))])

    def run(batches):
        hashes = Hashes()
        for batch in batches:
            digests, base = batch.column("digest").to_pylist(), 0
            for ids, texts in slices(batch, 2 << 20):
                rows, parts = [], []
                for n, text in enumerate(texts):
                    words = words_of(text)
                    for a in range(0, len(words), BLOCK):
                        h = hashes.of(words[a:a + BLOCK + max(ks) - 1])
                        for k in ks:
                            g = _runs(h, k)[:BLOCK]
                            if len(g):
                                rows.append((ids[n], digests[base + n], a))
                                parts.append(g)
                base += len(ids)
                if rows:
                    lists = pa.ListArray.from_arrays(pa.array(bounds([len(p) for p in parts]), pa.int32()), pa.array(np.concatenate(parts).view(np.int64)))
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in zip(*rows)), lists], schema=schema)
    return run


def spans(docs: DataFrame, known: list[Template]) -> DataFrame:
    """``doc_id``, ``digest``, ``template``, ``lo``, ``hi``: where in which text a template may stand, places of first and last hit."""
    hits = docs.mapInArrow(_hashed(sorted({t.run for t in known})), "doc_id long, digest long, first long, grams array<long>")
    hits = hits.select("doc_id", "digest", "first", F.posexplode("grams").alias("pos", "gram")).join(_index(docs.sparkSession, known), "gram")
    hits = hits.select("doc_id", "digest", "template", "exact", "votes", "place", (F.col("first") + F.col("pos")).alias("at"))
    # All that follows is by text; a text that is there twice votes once.
    hits = hits.repartition("doc_id", "digest").dropDuplicates(["doc_id", "digest", "template", "place", "at"])
    text = ["doc_id", "digest", "template", "exact", "votes"]
    lines = hits.groupBy(*text, (F.col("at") - F.col("place")).alias("diagonal")).agg(F.count("*").alias("n"), F.min("at").alias("lo"), F.max("at").alias("hi"))
    order = Window.partitionBy(*text).orderBy("diagonal")
    new = F.col("exact") | (F.col("diagonal") - F.coalesce(F.lag("diagonal").over(order), F.lit(-1 << 40)) > GAP)
    lines = lines.withColumn("new", new.cast("int")).withColumn("group", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = lines.groupBy(*text, "group").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return merged.where("n >= votes").select("doc_id", "digest", "template", "lo", "hi")


def common_length(a: list[bytes], b: tuple[bytes, ...]) -> int:
    """Length of the longest common subsequence, a bit for each word of ``b``."""
    at: dict[bytes, int] = {}
    for j, w in enumerate(b):
        at[w] = at.get(w, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for w in a:
        if m := at.get(w):
            x = row & m
            row = ((row + x) | (row - x)) & full
    return len(b) - row.bit_count()


def verified(words: list[bytes], found: list[tuple[int, int, int]], known: list[Template], share: float, dense: float) -> list[tuple[int, int, int, float]]:
    """Template, start, end and share of the template's words of the spans that hold."""
    exact, other = [], []
    for t, lo, hi in sorted(found):
        x = known[t]
        m = len(x.words)
        if x.exact:
            if tuple(words[lo:lo + m]) == x.words:
                exact.append((t, lo, lo + m, 1.0))
            continue
        for a in range(lo, hi + 1, m):  # merged diagonals may go on and on, where a text repeats itself
            z = min(hi + x.run, a + 2 * m)
            n = common_length(words[a:z], x.words)
            if n >= share * m and n >= dense * min(z - a, m):
                other.append((2 * n / (m + z - a), t, a, z, n / m))
    kept: list[tuple[int, int, int, float]] = []
    for _, t, a, z, part in sorted(other, key=lambda s: (-s[0], s[1:])):
        i = bisect_left(kept, a, key=lambda s: s[1])
        if (i == 0 or kept[i - 1][2] <= a) and (i == len(kept) or z <= kept[i][1]):
            kept.insert(i, (t, a, z, part))
    return exact + kept


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.string())])
DDL = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string"


def _judged(known: list[Template], share: float, dense: float):
    def judge(text: bytes, found):
        words = words_of(text)
        spans = verified(words, [(s["template"], s["lo"], s["hi"]) for s in found or ()], known, share, dense)
        base = sorted({a for t, a, _, _ in spans if known[t].exact})
        names = lambda exact: ",".join(sorted({known[t].label for t, *_ in spans if known[t].exact or not exact}))
        return (len(words), sum(known[t].exact for t, *_ in spans), base[0] if base else None, base[-1] if base else None, names(True), names(False),
                max((part / 2 if known[t].exact else part for t, _, _, part in spans), default=0.0),
                ",".join(f"{known[t].label}:{a}:{z}" for t, a, z, _ in sorted(spans, key=lambda s: (s[1], s[0]))))

    def run(batches):
        for batch in batches:
            found, base = batch.column("found"), 0
            for ids, texts in slices(batch, 2 << 20):
                rows = [(i, *judge(text, found[base + n].as_py())) for n, (i, text) in enumerate(zip(ids, texts))]
                base += len(ids)
                yield to_batch(SCHEMA, **dict(zip(SCHEMA.names, map(list, zip(*rows)))))
    return run


def scan(docs: DataFrame, known: list[Template] | None = None, share: float = 0.8, dense: float = 0.7) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score`` and the verified ``spans`` (label:start:end) of every row.

    A text template needs ``share`` of its words, in order, in a span of which ``dense`` belongs to it. Base columns count exact templates only.
    Texts without any candidate are not shuffled; the filter of the others' ids has a fixed size, and a join by id and digest decides.
    """
    known, docs = templates() if known is None else known, keyed(docs)
    found = spans(docs, known).groupBy("doc_id", "digest").agg(F.sort_array(F.collect_list(F.struct("template", "lo", "hi"))).alias("found"))
    found = store(found, "spans")
    ids = docs.sparkSession.sparkContext.broadcast(IdFilter.of(found.select("doc_id").where("doc_id is not null")))
    judged, kind = _judged(known, share, dense), "array<struct<template:int,lo:bigint,hi:bigint>>"
    plain = docs.select("doc_id", "text", F.lit(None).cast(kind).alias("found"))

    # The only rows to be joined: those whose id is in the filter, or null.
    near = docs.mapInArrow(holding(ids, _passed), "doc_id long, digest long, text string")
    key = near.doc_id.eqNullSafe(found.doc_id) & (near.digest == found.digest)
    joined = near.join(found, key, "left").select(near.doc_id, near.text, found.found)
    return plain.mapInArrow(skipping(ids, judged), DDL).unionByName(joined.mapInArrow(judged, DDL))


def _passed(batches):
    for b in batches:
        yield b.select(["doc_id", "digest", "text"])
