"""Token counts by a finite-state transducer compiled from a sentence-piece BPE model.

The transducer reads letters. Behind every prefix of a run of letters stands one last token (a token may follow another if merging the letters of both
keeps them apart, and exactly one token that ends at the prefix follows the last token of what is before it), so a letter changes the number of tokens by a fixed
amount: what its transition emits. A state is what the future can depend on: the longest end of the prefix that begins some piece, the last token at each of its
letters and the tokens between them; prefixes that agree in these share a state. A visible letter followed by a word mark, and letters that occur in no longer
piece, lead back to the first state. States and transitions are determinised when first met and kept in bounded memory.

A chunk of text that starts anywhere maps the state it is entered with to a count and a new state. Such a map is a head (what
stands before the first return to the first state), a count for the middle, and a tail (what is behind the last one), or only an open stretch. Two maps compose to one,
associatively: every text is read as chunks whose maps are composed, within its task, or for long ones over many tasks, pairwise and by levels, like a prefix scan.

Null and empty texts have no tokens. Rows are independent: repeated rows and ids give repeated rows.
Very long texts are counted in chunks; null ids are kept. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from scriptorium.llm.common import slices, to_batch, two_columns

#: States a worker keeps; they are built anew when there are more.
STATES = 250_000
#: Letters of a chunk; of a text that is cut into rows.
CHUNK, LONG = 1 << 12, 1 << 15
MARK = "▁"
NEVER = float("inf")
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


def _fields(data: bytes):
    """The fields of a protocol-buffer message: number and value."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            n = varint() if kind == 2 else 8 if kind == 1 else 4
            yield key >> 3, data[at:at + n]
            at += n


class Transducer:
    """The model's pieces, and the states and transitions compiled so far. State 0 is the first one."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            model = list(_fields(f.read()))
        self.score: dict[str, float] = {}
        settings = {}
        fallback = False
        for number, value in model:
            if number == 1:
                piece = dict(_fields(value))
                if piece.get(3, 1) in (1, 4):
                    self.score[piece[1].decode()] = struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0]
            elif number == 2:
                trainer = dict(_fields(value))
                fallback, bpe = bool(trainer.get(35, 0)), trainer.get(3, 1) == 2
            elif number == 3:
                settings = dict(_fields(value))
        if not bpe or settings.get(2) or settings.get(4, 1) or not settings.get(3, 1) or not settings.get(5, 1):
            raise ValueError("a BPE model with identity normalisation, dummy prefix and all white space kept is needed")
        if any(MARK in p.lstrip(MARK) for p in self.score):
            raise ValueError("no piece may hold a word mark after a letter")
        self.fallback = fallback
        self.joins = {c for p in self.score if len(p) > 1 for c in p}
        self.beginnings = {p[:n] for p in self.score for n in range(len(p))}
        best = max(self.score.values())
        #: When a piece is merged: the best score first.
        self.when = {p: best - x for p, x in self.score.items() if len(p) > 1}
        self.splits: dict[str, tuple[str, str] | None] = {}
        self.restart()

    def restart(self) -> None:
        self.arcs: list[dict[str, tuple[int, int]]] = [{}]
        self.parent, self.letter, self.last, self.tokens, self.begun = [-1], [""], [""], [0], [""]
        self.known: dict[tuple, int] = {}

    def halves(self, piece: str) -> tuple[str, str] | None:
        """The two tokens that are merged last into a piece; None if merging its letters does not lead to it."""
        if piece not in self.splits:
            parts, last = list(piece), None
            while len(parts) > 1:
                found = [self.when.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
                i = found.index(min(found))
                if found[i] == NEVER:
                    last = None
                    break
                last = parts[i], parts[i + 1]
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            self.splits[piece] = last
        return self.splits[piece]

    def fits(self, a: str, b: str) -> bool:
        """Whether token ``b`` may follow token ``a`` (or begin, where ``a`` is empty): at no time do merging what stands on both sides come first.

        From the end back in time: of the two tokens the one merged later is taken apart, up to its letters. A merge across at the same time as one
        to its right comes first, being further left.
        """
        if len(b) > 1 and not self.halves(b):
            return False
        if not a:
            return True
        when, until, across_first = self.when, NEVER, False
        while True:
            across = when.get(a + b)
            if across is not None and (across < until or (across_first and across == until)):
                return False
            left, right = when.get(a, -1.0) if len(a) > 1 else -1.0, when.get(b, -1.0) if len(b) > 1 else -1.0
            if left < 0 and right < 0:
                return True
            if left > right:
                until, across_first, a = left, False, self.halves(a)[1]
            else:
                until, across_first, b = right, True, self.halves(b)[0]

    def single(self, letter: str) -> int:
        return 1 if letter in self.score or not self.fallback else len(letter.encode())

    def extend(self, state: int, letter: str) -> tuple[int, int]:
        """Compile the transition of a state by a letter: the next state, and the tokens it emits."""
        if letter not in self.joins:
            arc = 0, self.single(letter)
        elif letter == MARK and state and self.letter[state] != MARK:
            arc = self.arcs[0].get(MARK) or self.extend(0, MARK)
        else:
            token, before = letter, state
            while not ((len(token) == 1 or token in self.score) and self.fits(self.last[before], token)):
                token, before = self.letter[before] + token, self.parent[before]
            count = self.tokens[before] + (1 if len(token) > 1 else self.single(token))
            arc = self.state(state, letter, token, count), count - self.tokens[state]
        self.arcs[state][letter] = arc
        return arc

    def state(self, parent: int, letter: str, token: str, count: int) -> int:
        """The state behind a prefix. A later token can begin only where the letters since begin some piece: back to there the last tokens count, and the tokens since."""
        begun = self.begun[parent] + letter
        while begun not in self.beginnings:
            begun = begun[1:]
        window, at = [begun, token], parent
        for _ in begun:
            window += (count - self.tokens[at], self.last[at])
            at = self.parent[at]
        key = tuple(window)
        got = self.known.get(key)
        if got is None:
            got = self.known[key] = len(self.arcs)
            self.arcs.append({})
            self.parent.append(parent)
            self.letter.append(letter)
            self.last.append(token)
            self.tokens.append(count)
            self.begun.append(begun)
        return got

    def middle(self, text: str) -> int:
        """Tokens emitted from the first state: ``text`` is empty or begins with a word mark (as a blank)."""
        if len(self.arcs) > STATES:
            self.restart()
        arcs, extend, state, count = self.arcs, self.extend, 0, 0
        for c in text.replace(" ", MARK):
            arc = arcs[state].get(c)
            if arc is None:
                arc = extend(state, c)
            state, n = arc
            count += n
        return count

    def state_map(self, chunk: str) -> tuple[str, int, str, bool]:
        """Head, count, tail, and whether the chunk has a border at all (without one, it is all head)."""
        first = _BORDER.search(chunk)
        if not first:
            return chunk, 0, "", False
        start, last = first.end() - 1, _LAST.match(chunk).end(1)
        return chunk[:start], self.middle(chunk[start:last]), chunk[last:], True

    def compose(self, a: tuple[str, int, str, bool], b: tuple[str, int, str, bool]) -> tuple[str, int, str, bool]:
        """The map of two chunks in a row. What is open where they meet is read again: it may hold a border."""
        meet = a[2] + b[0] if a[3] else a[0] + b[0]
        if a[3] and b[3]:
            return a[0], a[1] + self.middle(meet) + b[1], b[2], True
        head, count, tail, border = self.state_map(meet)
        if a[3]:  # closed on the left, where it begins with a word mark
            return (a[0], a[1] + self.middle(head) + count, tail, True) if border else (a[0], a[1], meet, True)
        if b[3]:
            return (head, count + self.middle(tail) + b[1], b[2], True) if border else (meet, b[1], b[2], True)
        return head, count, tail, border

    def total(self, m: tuple[str, int, str, bool]) -> int:
        """Tokens of a whole text that began with the first word mark."""
        return self.middle(m[0]) + m[1] + self.middle(m[2])

    def scan(self, maps: list[tuple[str, int, str, bool]]) -> tuple[str, int, str, bool]:
        """Maps of chunks in a row composed pairwise, level by level."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]

    def count(self, text: str) -> int:
        """All tokens: the maps of the text's chunks, composed and entered at the first state."""
        if not text:
            return 0
        whole = " " + text.replace(MARK, " ")
        return self.total(self.scan([self.state_map(whole[a:a + CHUNK]) for a in range(0, len(whole), CHUNK)]))


_BORDER = re.compile(r"[^ ] ")
_LAST = re.compile(r"(?s)(.*[^ ]) ")
_ready: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One per worker process and file."""
    if path not in _ready:
        _ready[path] = Transducer(path)
    return _ready[path]


def _counts(path: str, limit: int):
    def run(batches):
        tr = transducer(path)
        for batch in batches:
            for ids, texts in slices(batch, 4 << 20):
                n = [tr.count(t.decode("utf-8", "replace")) for t in texts]
                yield to_batch(SCHEMA, doc_id=ids, n_bytes=list(map(len, texts)), n_tokens=n, over_limit=[x > limit for x in n])
    return run


_CHUNKS = "doc_id long, digest string, n_bytes long, chunk int, text string"
_MAPS = "doc_id long, digest string, n_bytes long, chunk int, copies long, head string, n long, tail string, border boolean"


def _cut(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.string()), ("n_bytes", pa.int64()), ("chunk", pa.int32()), ("text", pa.string())])
    for batch in batches:
        for ids, texts in slices(batch):
            for i, raw in zip(ids, texts):
                t = " " + raw.decode("utf-8", "replace").replace(MARK, " ")
                n = -(-len(t) // LONG)
                digest = hashlib.md5(raw).hexdigest()
                for a in range(0, n, 64):
                    own = range(a, min(n, a + 64))
                    yield to_batch(schema, doc_id=[i] * len(own), digest=[digest] * len(own), n_bytes=[len(raw)] * len(own), chunk=list(own),
                                   text=[t[k * LONG:(k + 1) * LONG] for k in own])


def _map_chunks(path: str):
    names = [f.split()[0] for f in _MAPS.split(", ")]

    def run(batches):
        tr = transducer(path)
        for b in batches:
            maps = [tr.state_map(t) for t in b.column("text").to_pylist()]
            own = {k: b.column(k) for k in ("doc_id", "digest", "n_bytes", "chunk", "copies")}
            own |= {"head": pa.array([m[0] for m in maps], pa.string()), "n": pa.array([m[1] for m in maps], pa.int64()),
                    "tail": pa.array([m[2] for m in maps], pa.string()), "border": pa.array([m[3] for m in maps], pa.bool_())}
            yield pa.RecordBatch.from_pydict({k: own[k] for k in names})
    return run


def _fold(path: str, level: int):
    """Compose the maps of a group, in order, into one of the next level."""
    def run(pdf):
        tr = transducer(path)
        pdf = pdf.sort_values("chunk")
        head, n, tail, border = tr.scan(list(zip(pdf["head"], pdf["n"], pdf["tail"], pdf["border"])))
        if level == 2:
            n, head, tail = tr.total((head, n, tail, border)), "", ""
        out = pdf.iloc[:1].copy()
        out["chunk"], out["head"], out["n"], out["tail"], out["border"] = out["chunk"] // FAN, head, n, tail, border
        return out
    return run


#: Maps composed at once; two levels serve texts of up to FAN * FAN chunks, more than a row can hold.
FAN = 256


def count_tokens(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).

    The chunks of texts of more than ``LONG`` letters are rows, mapped wherever there is room, and composed in two levels; those of others are composed in their task.
    """
    docs = two_columns(docs)
    long = F.length("text") > LONG
    short = docs.where(F.col("text").isNull() | ~long).mapInArrow(_counts(path, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
    keys = ["doc_id", "digest", "n_bytes"]
    chunks = docs.where(long).mapInArrow(_cut, _CHUNKS).groupBy(*keys, "chunk").agg(F.count("*").alias("copies"), F.min("text").alias("text"))
    maps = chunks.mapInArrow(_map_chunks(path), _MAPS)
    for level in (1, 2):
        maps = maps.groupBy(*keys, (F.col("chunk") / FAN).cast("int").alias("block")).applyInPandas(_fold(path, level), _MAPS)
    whole = maps.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        "doc_id", "n_bytes", F.col("n").alias("n_tokens"), (F.col("n") > limit).alias("over_limit"))
    return short.unionByName(whole)
