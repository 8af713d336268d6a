"""The prefix trie against a plain one, with chunks so small that most nodes lie on a boundary."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from scriptorium.llm import conversation_trie as ct

SCHEMA = "conv_id long, turn long, role string, text string, key string, path long, n_convs int"


def plain(turns, heads=True):
    convs = {}
    for c, turn, role, text in turns:
        if c is not None:
            convs.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    convs = {c: [(r, t) for _, r, t in sorted(v, key=lambda x: x[0])] for c, v in convs.items()}
    if heads:
        fmod = lambda c: c - int(c - 100 * int(c / 100))
        built = {}
        for c, own in convs.items():
            h = (zlib.crc32(str(c).encode()) & 0xFFFFFFFF) % 6
            built[c] = convs.get(fmod(c), [])[:h] + own[h:]
        convs = built
    members = {}
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    kids, out = {}, []
    for n in members:
        if n:
            kids.setdefault(n[:-1], []).append(n)

    def sums(n):
        leaves, saved = (0 if n in kids else 1), (len(members[n]) - 1) * len(n[-1][1]) if n else 0
        for k in kids.get(n, []):
            a, b = sums(k)
            leaves, saved = leaves + a, saved + b
        out.append((min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), len(kids.get(n, [])), leaves, saved,
                    hashlib.sha256(",".join(str(c) for c in sorted(members[n]) if len(convs[c]) == len(n)).encode()).hexdigest()))
        return leaves, saved

    if members:
        sums(())
    return sorted(out, key=repr)


def trie(spark, turns, heads=True):
    df = spark.createDataFrame([(*t, "k", 1, 2) for t in turns], SCHEMA).repartition(4)
    convs = ct.conversations(df)
    if heads:
        c = F.col("conv_id")
        convs = ct.with_heads(convs, convs.select("conv_id", (c - c % 100).alias("head_id"), (F.crc32(c.cast("string")) % 6).alias("h")), 5)
    return sorted(map(tuple, ct.prefix_trie(convs).collect()), key=repr)


def talks(n, seed=0):
    rng = random.Random(seed)
    out = []
    for c in range(n):
        size = rng.choice([1, 2, 3, 5, 8, 40 if c % 50 == 7 else 4])
        rng.random()
        path = random.Random(rng.randint(0, 25))
        for turn in range(size):
            out.append((c, turn, path.choice(["user", "assistant", None]), path.choice(["hello", "ça va ?", "", None, "x" * path.randint(1, 9)])))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("chunk", [1, 7, 60, 50_000])
@pytest.mark.parametrize("heads", [True, False])
def test_against_a_plain_trie(spark, monkeypatch, chunk, heads):
    monkeypatch.setattr(ct, "CHUNK", chunk)
    monkeypatch.setattr(ct, "WIDTH", 3)
    monkeypatch.setattr(ct, "RANGES", 5)
    turns = talks(230)
    assert trie(spark, turns, heads) == plain(turns, heads)


def test_awkward_rows(spark, monkeypatch):
    turns = talks(40, 5) + [(-7, 3, "user", "a"), (-7, None, "user", "b"), (-250, 0, None, None), (-200, 0, "user", "z"), (100, 0, "user", "a"), (108, 0, "user", "b"), (108, 1, "a", "b"),
                            (None, 0, "user", "lost"), (300, 0, "usera", ""), (301, 0, "user", "a"), (302, 0, "user", "y" * 100_000)]
    turns += [(400 + i, t, "user", "the same") for i in range(100) for t in range(3)]
    assert trie(spark, turns) == plain(turns)
    monkeypatch.setattr(ct, "CHUNK", 10)
    assert trie(spark, turns) == plain(turns)
    again = turns + [t for t in turns if t[0] == 301]
    assert trie(spark, again, False) == plain(again, False)
    assert trie(spark, []) == [] and trie(spark, [(5, 0, "u", "t")]) == plain([(5, 0, "u", "t")])
