"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

The encoding of every prefix of a piece ends in exactly one token. It is found from the matches of
the vocabulary that end there (a matching automaton with suffix links gives them all), and is the one that
may follow the last token of the prefix before it: no merge of the two's inner tokens comes first.
Back-pointers from the end of the piece give the ids. Pieces are those of the usual byte-level pattern, kept in bounded
memory, since words repeat; the new ones of some texts go through this together, as arrays, prefix length by prefix length (their matches come from the
vocabulary's trie), and longer ones by themselves. A text's ids are then put together, and decoding joins the ids' bytes.

Null and empty texts have no tokens. Rows are independent: repeated rows and ids give repeated rows.
Very long texts are encoded whole; null ids are kept. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from itertools import chain, islice

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from scriptorium.llm.common import ODD, bounds, freeing, slices, to_batch, two_columns

# The pattern that byte-level BPE cuts texts with.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: The same for texts without letters, digits or white space beyond the Latin ones below; Python's own expressions are faster.
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
LATIN_PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LATIN}]+| ?[0-9]+| ?[^\t-\r 0-9{LATIN}]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
#: Pieces that a worker remembers: half of them since the last change, half from before.
WORDS = 100_000
#: Remembered pairs of tokens: places for the arrays, entries for long pieces.
PAIR_BITS, PAIRS = 19, 300_000
#: Longer pieces, in bytes, go through the automaton by themselves.
LONG = 64
#: Pieces that are taken together, and bytes of text.
TOGETHER, SLICE = 1 << 13, 1 << 20
NEVER = 1 << 60

SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.string()), ("decoded", pa.string())])
DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a vocabulary file: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Lookup:
    """Ints by distinct longs from 0 on, as arrays: a table of hashes with a step to the next place."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, (3 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        at, left = self.places(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] < 0]
            self.keys[at[free]] = keys[free]
            there = self.keys[at[left]] == keys[left]
            self.values[at[left[there]]] = values[left[there]]
            left = left[~there]
            at[left] = (at[left] + 1) & self.mask

    def places(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * ODD) >> self.shift).view(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """-1 for keys that are not there."""
        at = self.places(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], np.int32(-1))
        rest = np.flatnonzero((found != keys) & (found >= 0))
        while len(rest):
            at = (at[rest] if len(at) != len(rest) else at) + 1 & self.mask
            found, key = self.keys[at], keys[rest]
            hit = found == key
            out[rest[hit]] = self.values[at[hit]]
            on = ~hit & (found >= 0)
            rest, at = rest[on], at[on]
        return out


class Encoder:
    """A vocabulary made ready: matches, merges, splits, special strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        raw = {t: bytes(map(letters.__getitem__, t)) for t in vocab}
        self.size = max([*vocab.values(), *(t["id"] for t in spec.get("added_tokens", []))], default=0) + 1
        rank, halves, born = {}, {}, {}
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y, whole = vocab[a], vocab[b], vocab[a + b]
            rank.setdefault(x * self.size + y, r)
            if whole not in halves:
                halves[whole], born[whole] = (x, y), r
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        of = {i: raw[t] for t, i in vocab.items()} | {i: s.encode() for s, i in self.special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pattern, self.latin_pattern = regex.compile(PIECES), re.compile(LATIN_PIECES)
        self.raw = pa.array([of.get(i, b"") for i in range(self.size + 1)], pa.binary())
        self.marks = {s: str(i) for s, i in self.special.items()}
        self.words: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self._automaton, self.pairs = None, 0
        self._arrays(vocab, raw, rank, halves, born)

    def _arrays(self, vocab: dict[str, int], raw: dict[str, bytes], rank: dict[int, int], halves: dict[int, tuple[int, int]], born: dict[int, int]) -> None:
        """What :meth:`pieces` looks up: merges, halves, the trie of the tokens that stay whole, known pairs."""
        self.ranks = Lookup(np.fromiter(rank, np.int64, len(rank)), np.fromiter(rank.values(), np.int32, len(rank)))
        made = np.fromiter(halves, np.int64, len(halves))
        self.made_at, self.halved = np.full(self.size, -1, np.int64), np.zeros((2, self.size), np.int64)
        self.made_at[made] = np.fromiter(born.values(), np.int64, len(made))
        self.halved[:, made] = np.array(list(halves.values()), np.int64).reshape(-1, 2).T
        whole = np.ones(self.size, bool)
        whole[made] = self.all_compatible(*self.halved[:, made], self.made_at[made])
        self.lengths = np.zeros(self.size, np.int64)
        edges, tokens, self.whole = {}, [-1], []
        for t, i in vocab.items():
            self.lengths[i] = len(raw[t])
            if whole[i]:
                self.whole.append(i)
                node = 0
                for byte in raw[t]:
                    node = edges.setdefault(node << 9 | byte, len(tokens))
                    if node == len(tokens):
                        tokens.append(-1)
                tokens[node] = i
        self.trie = Lookup(np.fromiter(edges, np.int64, len(edges)), np.fromiter(edges.values(), np.int32, len(edges)))
        self.token_at = np.array(tokens, np.int64)
        letter = np.arange(257)
        self.begin = self.trie.get(letter)  # nodes after one byte, after two
        self.second = np.full((257, 512), -1, np.int32)
        self.second[:, :257] = self.trie.get((self.begin[:, None].astype(np.int64) << 9 | letter).ravel()).reshape(257, 257)
        self.known = np.full(1 << PAIR_BITS, -1, np.int64)
        self.name = pa.array(map(str, range(self.size)))

    @property
    def automaton(self):
        """For long pieces: matches of length, id and the tokens known to go before it or not."""
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for i in self.whole:
                token = self.raw[i].as_py()
                self._automaton.add_word(token.decode("latin-1"), (len(token), i, {}))
            self._automaton.make_automaton()
            there = self.ranks.keys >= 0
            self.rank = dict(zip(self.ranks.keys[there].tolist(), self.ranks.values[there].tolist()))
            self.born, self.halves = self.made_at.tolist(), self.halved.T.tolist()
        return self._automaton

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging leaves the border between two tokens alone; for long pieces, by what :attr:`automaton` has made ready.

        Run backwards: of the two tokens at the border the one made last is opened again, and at each moment
        the two that then touch must not have a merge earlier than what came next.
        """
        limit, right_next = NEVER, False  # the event that comes next, and whether it is right of the border: the left goes first
        while True:
            r = self.rank.get(left * self.size + right, NEVER)
            if r < limit or (r == limit and right_next):
                return False
            a, b = self.born[left], self.born[right]
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, right_next, left = a, False, self.halves[left][1]
            else:
                limit, right_next, right = b, True, self.halves[right][0]

    def all_compatible(self, left: np.ndarray, right: np.ndarray, before: np.ndarray) -> np.ndarray:
        """:meth:`compatible` for arrays of borders, until the merges ``before``."""
        out, row = np.zeros(len(left), bool), np.arange(len(left))
        limit, right_next = before, np.zeros(len(left), bool)
        while len(row):
            r = self.ranks.get(left * self.size + right)
            on = (r < 0) | (r > limit) | ((r == limit) & ~right_next)
            a, b = self.made_at[left], self.made_at[right]
            end = (a < 0) & (b < 0)
            out[row[on & end]] = True
            on &= ~end
            row, left, right, a, b = row[on], left[on], right[on], a[on], b[on]
            right_next = a <= b
            limit = np.maximum(a, b)
            left, right = np.where(right_next, left, self.halved[1, left]), np.where(right_next, self.halved[0, right], right)
        return out

    def may_follow(self, left: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether tokens stand beside each other; pairs are remembered in places by hash."""
        key = left * self.size + token
        at = ((key.view(np.uint64) * ODD) >> np.uint64(64 - PAIR_BITS)).view(np.int64)
        have = self.known[at]
        new = np.flatnonzero(have >> 1 != key)
        if len(new):
            good = self.all_compatible(left[new], token[new], np.full(len(new), NEVER))
            have[new] = key[new] << 1 | good
            self.known[at[new]] = have[new]
        return have & 1 == 1

    def pieces(self, texts: list[str]) -> list[str]:
        """Ids of pieces as decimals: the last token of every prefix, then the way back."""
        data = [t.encode() for t in texts]
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        ends = np.cumsum(sizes + 1)  # of the pieces: before each and at the end stands a place for nothing
        letters = np.frombuffer(b" " + b" ".join(data) + b" ", np.uint8).astype(np.int64)
        nothing = np.concatenate([[0], ends])
        letters[nothing] = 256
        length = np.arange(len(letters)) - np.repeat(nothing, np.append(sizes + 1, 1))  # of the prefix that ends here
        start = np.flatnonzero(length)
        at, node, found = start, None, []
        while len(at):  # matches from every start, byte by byte
            child = self.begin[letters[at]] if not found else self.second[letters[at - 1], letters[at]] if len(found) == 1 else self.trie.get(node << 9 | letters[at])
            on = child >= 0
            start, at, node = start[on], at[on], child[on].astype(np.int64)
            token = self.token_at[node]
            hit = token >= 0
            found.append((start[hit], at[hit], token[hit]))
            at = at + 1
        start, at, token = (np.concatenate(c) for c in zip(*found))
        del found
        order = np.argsort(length[at].astype(np.uint8), kind="stable")
        start, at, token = start[order], at[order], token[order]
        last = np.full(len(letters), -1, np.int64)
        cuts = bounds(np.bincount(length[at]))
        for a, b in zip(cuts[1:], cuts[2:]):  # prefixes of 1, 2, 3, ... bytes
            left, right = last[start[a:b] - 1], token[a:b]
            first = length[start[a:b] - 1] == 0
            good = first | ((left >= 0) & self.may_follow(left, right))
            last[at[a:b][good]] = right[good]
        row, at, back = np.arange(len(data)), ends - 1, []
        while len(row):
            token = last[at]
            if (token < 0).any():
                raise ValueError("bytes that the vocabulary does not have")
            back.append((row, token))
            at = at - self.lengths[token]
            on = length[at] > 0
            row, at = row[on], at[on]
        rows, tokens = (np.concatenate(c[::-1]) for c in zip(*back))
        names = self.name.take(pa.array(tokens[np.argsort(rows, kind="stable")]))
        offsets = pa.array(bounds(np.bincount(rows, minlength=len(data))), pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(offsets, names), ",").to_pylist()

    def piece(self, text: str) -> str:
        """Ids of one piece, of any length, by the automaton."""
        data = text.encode().decode("latin-1")
        last = [None] * (len(data) + 1)
        for end, match in self.automaton.iter(data):
            at = end + 1
            if last[at] is None:
                n, token, follows = match
                if n < at:
                    before = last[at - n]
                    if before is None:
                        continue
                    left = before[1]
                    good = follows.get(left)
                    if good is None:
                        good = follows[left] = self.compatible(left, token)
                        self.pairs += 1
                    if not good:
                        continue
                last[at] = match
        if self.pairs > PAIRS:
            self.pairs = 0
            for match in self.automaton.values():
                match[2].clear()
        ids, at = [], len(data)
        while at:
            n, token, _ = last[at]
            ids.append(str(token))
            at -= n
        return ",".join(ids[::-1])

    def pieces_of(self, text: str, cut: dict[str, list[str]]) -> list[str]:
        """A text without special strings, in pieces; ``cut`` remembers those of stretches.

        Before a blank after something visible there always is a border; where blanks meet other white space, only there.
        """
        if _LATIN.fullmatch(text):
            return self.latin_pattern.findall(text)
        out = []
        for part in _BORDER.split(text) if _DOUBLE.search(text) else text.replace(" ", "\0 ").split("\0") if "\0" not in text else _BORDER.split(text):
            got = cut.get(part)
            if got is None:
                got = cut[part] = self.pattern.findall(part)
            out += got
        return out

    def remember(self, pieces: dict[str, None]) -> list[str]:
        """Puts ids of distinct pieces, as decimals, into the table of words. The new ones."""
        if len(self.words) >= WORDS // 2:  # frequent pieces come back from the older half
            self.older, self.words = self.words, {}
        self.words |= self.marks
        words, older, new = self.words, self.older, []
        for p in pieces:
            if p not in words:
                got = older.get(p)
                if got is None:
                    new.append(p)
                else:
                    words[p] = got
        short = [p for p in new if len(p) <= LONG // 4 or len(p.encode()) <= LONG]
        for i in range(0, len(short), TOGETHER):
            words.update(zip(short[i:i + TOGETHER], self.pieces(short[i:i + TOGETHER])))
        if len(short) < len(new):
            words.update((p, self.piece(p)) for p in new if p not in words)
        return new

    def encode_all(self, texts: list[str]) -> list[str]:
        """Ids of each text as decimals joined by commas."""
        cut: dict[str, list[str]] = {}
        pieces = [list(chain.from_iterable([part] if part in self.special else self.pieces_of(part, cut) for part in self.cut.split(t))) if self.cut and self.cut.search(t)
                  else self.pieces_of(t, cut) for t in texts]
        new = self.remember(dict.fromkeys(chain.from_iterable(pieces)))
        out = [",".join(map(self.words.__getitem__, p)) for p in pieces]
        for p in new:
            if len(p) > LONG:
                del self.words[p]
        if len(self.words) > WORDS // 2:
            self.words = dict(islice(self.words.items(), WORDS // 2))
        return out

    def encode(self, text: str) -> str:
        return self.encode_all([text])[0]

    def decode_all(self, codes: list[str]) -> list[str]:
        """Texts that ids stand for."""
        ids = pc.split_pattern(pa.array([c or str(self.size) for c in codes]), ",")  # no ids: the empty last entry
        parts = self.raw.take(ids.flatten().cast(pa.int32()))
        return [b.decode("utf-8", "replace") for b in pc.binary_join(pa.ListArray.from_arrays(ids.offsets, parts), b"").to_pylist()]

    def decode(self, ids: str) -> str:
        return self.decode_all([ids])[0]


_LATIN = re.compile(r"[^\x80-\xbf\u0250-\U0010ffff]*")
_DOUBLE = re.compile(r"\s ")
_BORDER = re.compile(r"(?<=\S)(?= )")
_ready: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per task and file."""
    if path not in _ready:
        _ready[path] = Encoder(path)
    return _ready[path]


def _rows(path: str, digest: bool):
    def run(batches):
        try:
            yield from encoded(batches)
        finally:
            _ready.clear()  # before the memory is given back

    def encoded(batches):
        enc = encoder(path)
        for batch in batches:
            for ids, texts in slices(batch, SLICE):
                codes = enc.encode_all([t.decode("utf-8", "replace") for t in texts])
                back = enc.decode_all(codes)
                counts = [c.count(",") + 1 if c else 0 for c in codes]
                if digest:
                    yield to_batch(DIGESTS, doc_id=ids, n_tokens=counts,
                                   ids_sha256=[hashlib.sha256(c.encode()).hexdigest() for c in codes],
                                   decoded_sha256=[hashlib.sha256(t.encode()).hexdigest() for t in back])
                else:
                    yield to_batch(SCHEMA, doc_id=ids, n_tokens=counts, ids=codes, decoded=back)
    return run


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (decimals joined by commas) and ``decoded`` (the text they stand for)."""
    return two_columns(docs).mapInArrow(freeing(_rows(path, False)), "doc_id long, n_tokens long, ids string, decoded string")


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the digests of ids and decoded text."""
    return two_columns(docs).mapInArrow(freeing(_rows(path, True)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
