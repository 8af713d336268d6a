"""License scan against a plain version: all hits by double loops, sequences by dynamic programming."""

import random
import re

import pytest

from scriptorium.llm import licenses

SCHEMA = "doc_id long, text string, digest string, template int, found string, at int"
KNOWN = licenses.templates()
MIT = next(t for n, t in licenses.TEXTS if n == "mit-text")
GPL = next(t for n, t in licenses.TEXTS if n == "gpl-notice")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for j, y in enumerate(b):
            now.append(row[j] + 1 if x == y else max(row[j + 1], now[j]))
        row = now
    return row[-1]


def plain(rows, share=0.8, dense=0.7):
    out = []
    for doc, text in rows:
        w = plain_words(text)
        base, other = [], []
        for t, x in enumerate(KNOWN):
            p = [b.decode() for b in x.words]
            if x.exact:
                base += [(t, i, i + len(p), 1.0) for i in range(len(w)) if w[i:i + len(p)] == p]
                continue
            lines = {}
            for i in range(len(w) - x.run + 1):
                for j in range(len(p) - x.run + 1):
                    if w[i:i + x.run] == p[j:j + x.run]:
                        lines.setdefault(i - j, []).append(i)
            groups = []
            for d in sorted(lines):
                if groups and d - groups[-1][0] <= licenses.GAP:
                    groups[-1] = (d, groups[-1][1] + lines[d])
                else:
                    groups.append((d, lines[d]))
            for _, at in groups:
                if len(at) < max(1, min((len(p) - x.run + 1) // 4, 20)):
                    continue
                for a in range(min(at), max(at) + 1, len(p)):
                    z = min(max(at) + x.run, a + 2 * len(p))
                    n = plain_lcs(w[a:z], p)
                    if n >= share * len(p) and n >= dense * min(z - a, len(p)):
                        other.append((-2 * n / (len(p) + z - a), t, a, z, n / len(p)))
        kept = []
        for _, t, a, z, part in sorted(other):
            if all(z <= b or y <= a for _, b, y, _ in kept):
                kept.append((t, a, z, part))
        label = lambda s: ",".join(sorted({KNOWN[x[0]].label for x in s}))
        at = [a for _, a, _, _ in base]
        out.append((doc, len(w), len(base), min(at, default=None), max(at, default=None), label(base), label(base + kept),
                    max([0.5] * bool(base) + [x[3] for x in kept], default=0.0), sorted(f"{KNOWN[t].label}:{a}:{z}" for t, a, z, _ in base + kept)))
    return sorted(out, key=repr)


def scanned(spark, rows):
    df = spark.createDataFrame([(*r, "d", 1, "f", 2) for r in rows], SCHEMA).repartition(4)
    return sorted(((*r[:8], sorted(filter(None, r.spans.split(",")))) for r in licenses.scan(df).collect()), key=repr)


def texts():
    rng = random.Random(2)
    noise = lambda n: " ".join(rng.choice("the of software copy to any Lizenz über 3 permission".split()) for _ in range(n))
    mit, out = MIT.split(), []
    for i in range(40):
        w = list(mit if i % 2 else GPL.split())
        for _ in range(rng.randint(0, 30)):
            at = rng.randrange(len(w))
            w[at:at + rng.randint(0, 2)] = [rng.choice(["new", "Software", "the"])] * rng.randint(0, 2)
        out.append(noise(rng.randint(0, 30)) + " " + " ".join(w) + "\n" + noise(rng.randint(0, 30)))
    lines = [t for _, t in licenses.TEXTS[:7]]
    return out + [noise(20) + ". " + rng.choice(lines) + " " + noise(5) + rng.choice(lines) for _ in range(30)]


ROWS = [(i, t) for i, t in enumerate(texts())] + [
    (200, ""), (201, None), (None, "the MIT license"), (None, None), (202, "mit-license, MIT\tLICENSE; mit  license"), (203, "mit license apache license general public license"),
    (204, "general public"), (204, "public license general public license"), (205, "MIT license"), (205, "MIT license"), (206, "émit license mit licenseé"), (207, "mit license " * 3000),
    (208, "x " * 70_000 + "Apache License"), (209, MIT + " " + MIT), (210, " ".join(MIT.split()[:60])), (211, "permission is hereby " * 400), (-5, "MIT İ LICENSE mit license"),
    (212, "y" * 200_000 + " licensed under cc by nc 4 0"), (213, "\x00mit\x00license"),
]


def test_against_plain(spark):
    assert scanned(spark, ROWS) == plain(ROWS)


def test_nothing(spark):
    assert scanned(spark, []) == [] and scanned(spark, [(1, None)]) == [(1, 0, 0, None, None, "", "", 0.0, [])]


def test_blocks_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(licenses, "BLOCK", 5)
    assert scanned(spark, ROWS[:60]) == plain(ROWS[:60])


@pytest.mark.parametrize("seed", range(3))
def test_common_length(seed):
    rng = random.Random(seed)
    a, b = ([rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(0, 80))] for _ in range(2))
    assert licenses.common_length(a, tuple(b)) == plain_lcs(a, b)


def test_own_templates(spark):
    own = licenses.templates([("x", "one")], [("y", "two words"), ("z", "a b c d e f g h")])
    df = spark.createDataFrame([(1, "ONE two words a b c d X e f g h"), (2, "two, words")], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_base, r.labels, r.spans) for r in licenses.scan(df, own).collect()) == [(1, 1, "x,y,z", "x:0:1,y:1:3,z:3:12"), (2, 0, "y", "y:0:2")]
