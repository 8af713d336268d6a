"""Personal data by rules, and terms that give protected entities away by corpus co-occurrence.

E-mail and IP addresses, card and phone numbers are found by fixed patterns. Each distinct value is a protected entity. Over the whole
corpus, terms within six words of a mention are counted with it, and all occurrences of such terms; a term discloses
an entity if it stands by it in at least two different texts, mostly occurs there, and tells at least ``bits`` about
it: ``log2(p(entity | term) / p(entity))``. Disclosing terms are spans wherever they occur: above ``remove_bits`` they are removed, below
generalised. Spans of the rules stay as they are; terms inside them add nothing.

A null or empty text has no spans. A row without an id is treated as any other. Rows are independent: repeated rows and ids give repeated rows, and copies of a text
are no further support. What a single text shows is chance as well as not, so it discloses nothing.
Very long texts are read in linear time. An empty table gives no rows. Further columns are kept by ``sanitised_rows``, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from scriptorium.llm.anchors import keyed
from scriptorium.llm.common import IdFilter, freeing, may_be_in, skipping, store, unused

KINDS = ("email", "ip", "card", "phone")
NEAR = 6

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = re.compile(r"[0-9](?:[ .-]?[0-9])++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: A term: a run without blanks and ASCII punctuation; the same cut for bytes.
_TERM = re.compile(r"[^\x00-\x20!-/:-@\[-`{-\x7f]+")
_BLANK = bytes(32 if b < 33 or (b < 128 and not chr(b).isalnum()) else b for b in range(256))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` in code points, sorted. Every pattern is read in one direction, in linear time."""
    found, at, last = [], text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            found.append((start, 0, last))
        at = text.find("@", max(at + 1, last))
    for run in _DIGITS.finditer(text):
        a, b = run.span()
        if b - a < 7:
            continue
        for m in _IP.finditer(text, a, b):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text, a, b):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def _hash(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


def _contexts(batches):
    """Each mention: entity, the digest of its text, and the terms by it."""
    schema = pa.schema([("entity", pa.int64()), ("digest", pa.int64()), ("terms", pa.list_(pa.string()))])
    for b in batches:
        rows = []
        for t, digest in zip(b.column("text").to_pylist(), b.column("digest").to_pylist()):
            for start, kind, end in rule_spans(t) if t else ():
                words = [m.encode().lower() for m in terms_before(t, start) + terms_after(t, end)]
                entity = _hash(f"{KINDS[kind]}:{t[start:end].lower()}".encode())
                rows.append((entity, digest, sorted({w.decode() for w in words if len(w) > 2})))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def terms_before(text: str, start: int) -> list[str]:
    """The last ``NEAR`` terms before a place, however long they are."""
    size = 400
    while True:
        a = max(0, start - size)
        found = list(_TERM.finditer(text, a, start))
        if a and found and found[0].start() == a:  # perhaps the end of a longer one
            found = found[1:]
        if not a or len(found) >= NEAR:
            return [m[0] for m in found[-NEAR:]]
        size *= 4


def terms_after(text: str, end: int) -> list[str]:
    """The first ``NEAR`` terms behind a place, however long they are."""
    return [m[0] for m in islice(_TERM.finditer(text, end), NEAR)]


def _term_counts(shared):
    def run(batches):
        count: dict[bytes, int] = {}
        for b in batches:
            for word in _wanted(b, shared.value):
                count[word] = count.get(word, 0) + 1
            if len(count) > 100_000:
                yield _count_batch(count)
                count = {}
        yield _count_batch(count)
    return run


def _count_batch(count):
    return pa.RecordBatch.from_pydict({"term": pa.array([w.decode("utf-8", "replace") for w in count], pa.string()), "n": pa.array(list(count.values()), pa.int64())})


class _Flags(dict):
    """Word to whether the filter may hold it."""

    def __init__(self, ids: IdFilter):
        super().__init__()
        self.ids = ids

    def __missing__(self, word: bytes) -> bool:
        if len(self) > 100_000:
            self.clear()
        got = self[word] = bool(self.ids.has(np.array([_hash(word)]))[0])
        return got

    def learn(self, words: list[bytes]) -> None:
        fresh = list({w for w in words if w not in self})
        if fresh:
            self.update(zip(fresh, self.ids.has(np.array([_hash(w) for w in fresh], np.int64)).tolist()))


def _wanted(batch, ids: IdFilter):
    flags = _Flags(ids)
    for t in batch.column("text").cast(pa.binary()).to_pylist():
        if t:
            words = t.lower().translate(_BLANK).split()
            flags.learn(words)
            if any(map(flags.__getitem__, words)):
                yield from (w for w in words if flags[w])


def _term_ids(terms: DataFrame) -> DataFrame:
    """The hashes that the filter knows terms by."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"id": pa.array([_hash(t.encode()) for t in b.column("term").to_pylist()], pa.int64())})
    return terms.select("term").mapInArrow(run, "id long")


def disclosing_terms(docs: DataFrame, support: int = 2, share: float = 0.5, bits: float = 5.0) -> DataFrame:
    """``term``, ``bits`` of all terms that give an entity away, from counts over the whole corpus."""
    spark = docs.sparkSession
    keys = docs.select("text", F.xxhash64("text").alias("digest"))
    near = store(keys.mapInArrow(freeing(_contexts), "entity long, digest long, terms array<string>"), "contexts")
    entities = near.groupBy("entity").agg(F.count("*").alias("n_entity"))
    pairs = near.select("entity", "digest", F.explode("terms").alias("term"))
    pairs = pairs.groupBy("term", "entity", "digest").agg(F.count("*").alias("n")).groupBy("term", "entity").agg(F.sum("n").alias("joint"), F.count("*").alias("texts"))
    pairs = store(pairs.where(F.col("texts") >= support), "pairs")
    ids = spark.sparkContext.broadcast(IdFilter.of(_term_ids(pairs.select("term").distinct()), 22))
    total = docs.select("text").mapInArrow(freeing(_term_counts(ids)), "term string, n long").groupBy("term").agg(F.sum("n").alias("n_term"))
    told, mentions = pairs.join(total, "term").join(entities, "entity"), near.count()
    told = told.where(F.col("joint") >= share * F.col("n_term")).withColumn(
        "bits", F.log2(F.col("joint") / F.col("n_term") * mentions / F.col("n_entity")))
    return store(told.where(F.col("bits") >= bits).groupBy("term").agg(F.max("bits").alias("bits")), "disclosing")


def _occurrences(shared):
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches):
        for b in batches:
            flags, rows = _Flags(shared.value), []
            for i, g, t in zip(*(b.column(c).to_pylist() for c in ("doc_id", "digest", "text"))):
                words = t.encode().lower().translate(_BLANK).split() if t else []
                flags.learn(words)
                if any(map(flags.__getitem__, words)):
                    base = rule_spans(t)
                    for m in _TERM.finditer(t):
                        w = m[0].encode().lower()
                        if flags[w] and not any(a < m.end() and m.start() < e for a, _, e in base):
                            rows.append((i, g, w.decode(), m.start(), m.end()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)
    return run


_RESULT = pa.schema([*((n, pa.int64()) for n in ("doc_id", "n_email", "n_ip", "n_card", "n_phone")), ("base_sha256", pa.string()), ("spans", pa.string()), ("clean", pa.string())])
_RESULT_SQL = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, clean string"


def _redact(text: str, spans: list[tuple[int, str, int, str]]) -> str:
    out, at = [], 0
    for start, _, end, by in sorted(spans):
        if start >= at:
            out += [text[at:start], by]
        at = max(at, end)
    return "".join(out) + text[at:]


def _final(texts: bool):
    def run(batches):
        for b in batches:
            rows = []
            for i, t, more in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "terms"))):
                base = rule_spans(t) if t else []
                names = [(s, KINDS[k], e, f"[{KINDS[k]}]") for s, k, e in base]
                joined = ",".join(f"{k}:{s}:{e}" for s, k, e, _ in names)
                every = names + [(m["start"], "term", m["end"], "" if m["remove"] else "[term]") for m in more or ()]
                order = {k: n for n, k in enumerate((*KINDS, "term"))}
                spans = ",".join(f"{k}:{s}:{e}" for s, k, e, _ in sorted(every, key=lambda x: (x[0], order[x[1]], x[2])))
                counts = [sum(k == n for _, k, _ in base) for n in range(4)]
                clean = (None if t is None else _redact(t, every)) if texts else None
                rows.append((i, *counts, hashlib.sha256(joined.encode()).hexdigest(), spans, clean))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_RESULT)], schema=_RESULT)
    return run


def _term_marks(docs: DataFrame, remove_bits: float, **limits) -> DataFrame:
    """Where disclosing terms occur, gathered by text (``doc_id``, ``digest``)."""
    terms = disclosing_terms(docs, **limits)
    known = docs.sparkSession.sparkContext.broadcast(IdFilter.of(_term_ids(terms), 22))
    there = docs.mapInArrow(freeing(_occurrences(known)), "doc_id long, digest long, term string, start int, end int")
    marks = there.join(terms, "term").select("doc_id", "digest", "start", "end", (F.col("bits") >= remove_bits).alias("remove")).distinct()
    return store(marks.groupBy("doc_id", "digest").agg(F.collect_list(F.struct("start", "end", "remove")).alias("terms")), "terms")


def sanitise(docs: DataFrame, texts: bool = True, remove_bits: float = 12.0, **limits) -> DataFrame:
    """``doc_id``, numbers of rule spans, ``base_sha256``, ``spans`` and, with ``texts``, the ``clean`` text.

    Only texts that may hold a disclosing term, and rows without an id, are joined with its occurrences; the others are not shuffled.
    """
    docs, spark = keyed(docs), docs.sparkSession
    marks = _term_marks(docs, remove_bits, **limits)
    ids = spark.sparkContext.broadcast(IdFilter.of(marks.select("doc_id")))
    plain = docs.select("doc_id", "text", F.lit(None).cast(marks.schema["terms"].dataType).alias("terms"))
    marked = marks.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), "terms")
    key = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest"))
    rest = docs.where(may_be_in(ids, "doc_id") | F.col("doc_id").isNull()).join(marked, key, "left").select("doc_id", "text", "terms")
    out = plain.mapInArrow(skipping(ids, _final(texts)), _RESULT_SQL).unionByName(rest.mapInArrow(_final(texts), _RESULT_SQL))
    return out if texts else out.drop("clean")


def sanitised_rows(docs: DataFrame, remove_bits: float = 12.0, **limits) -> DataFrame:
    """``docs`` with all columns, the text sanitised and ``n_chars``, where there is one, brought up to date."""
    spark, schema = docs.sparkSession, docs.schema
    marks = _term_marks(keyed(docs), remove_bits, **limits)
    ids = spark.sparkContext.broadcast(IdFilter.of(marks.select("doc_id")))
    kind = marks.schema["terms"].dataType

    def run(batches):
        for b in batches:
            clean = [None if t is None else _redact(t, [*((s, "", e, f"[{KINDS[k]}]") for s, k, e in rule_spans(t)), *((m["start"], "", m["end"], "" if m["remove"] else "[term]") for m in more or ())])
                     for t, more in zip(b.column("text").to_pylist(), b.column(b.num_columns - 1).to_pylist())]
            out = [b.column(i) for i in range(b.num_columns - 1)]
            for i, name in enumerate(b.schema.names[:-1]):
                if name == "text":
                    out[i] = pa.array(clean, b.schema.field(i).type)
                elif name == "n_chars":
                    out[i] = pa.array([None if t is None else len(t) for t in clean], b.schema.field(i).type)
            yield pa.RecordBatch.from_arrays(out, names=b.schema.names[:-1])

    own, same, terms = unused(docs, "__id", "__digest", "__terms")
    plain = docs.select("*", F.lit(None).cast(kind).alias(terms))
    marked = marks.select(F.col("doc_id").alias(own), F.col("digest").alias(same), F.col("terms").alias(terms))
    key = F.col("doc_id").cast("long").eqNullSafe(F.col(own)) & (F.xxhash64(F.col("text").cast("string")) == F.col(same))
    # Stored, so that no task needs a second Python worker, for the filter and for the texts.
    rest = store(docs.where(may_be_in(ids, "doc_id") | F.col("doc_id").isNull()).join(marked, key, "left").drop(own, same), "marked")
    return plain.mapInArrow(freeing(skipping(ids, run)), schema).unionByName(rest.mapInArrow(freeing(run), schema))
