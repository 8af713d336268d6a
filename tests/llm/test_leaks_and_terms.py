"""Benchmark leaks and disclosing terms against plain versions."""

import math
import random
from collections import Counter

from scriptorium.llm import decontaminate as D
from scriptorium.llm import privacy as P


def plain_leaks(rows, items, threshold=0.5, overlap=0.5):
    words = {i: [w.decode() for w in D.words_of(t.encode())] for i, t in items}
    df = Counter(w for ws in words.values() for w in set(ws))
    mean = sum(map(len, words.values())) / len(words)
    grams = lambda w: {tuple(w[i:i + min(3, len(w))]) for i in range(len(w) - min(3, len(w)) + 1)} if w else set()
    share = lambda x, w: sum(any(tuple(w[i:i + len(g)]) == g for i in range(len(w))) for g in x) / len(x) if x else 0.0
    out = set()
    for k, t in items:
        own = words[k]
        tf = Counter(own)
        weight = {w: math.log(1 + (len(words) - df[w] + 0.5) / (df[w] + 0.5)) * f * (D.K1 + 1) / (f + D.K1 * (1 - D.B + D.B * len(own) / mean)) for w, f in tf.items()}
        whole = sum(weight.values())
        q, a = ([w.decode() for w in x] for x in D.question_answer(t))
        step = D.passage_of(len(own)) // 2
        for n, (doc, text) in enumerate(rows):
            w = [x.decode() for x in D.words_of((text or "").encode())]
            for p in range(max(1, -(-len(w) // step) - 1)):
                if sum(weight.get(x, 0) for x in set(w[p * step:(p + 2) * step])) / whole < threshold:
                    continue
                around = w[max(0, (p - 1) * step):(p + 3) * step]
                answer = share(grams(a), around)
                if answer < overlap and len(a) < D.LEAST_ANSWER:
                    answer = share(grams(own[-D.LEAST_ANSWER:]), around)
                if share(grams(q), around) >= overlap and answer >= overlap:
                    out.add((n, doc, k))
    return sorted((doc, k) for _, doc, k in out)


def corpus(seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, f"{line(rng.randint(2, 60))}? {line(rng.randint(1, 25))}.") for i in range(30)] + [(90, f"{line(400)}. {line(60)}")]
    rows = []
    for i in range(60):
        q, a = D.question_answer(rng.choice(items)[1])
        part = (q + a)[rng.randint(0, 8):]
        for _ in range(rng.randint(0, len(part) // 3)):
            part[rng.randrange(len(part))] = rng.choice(words).encode()
        rows.append((i, f"{line(rng.randint(0, 200))} {b' '.join(part).decode()} {line(rng.randint(0, 200))}"))
    return items, rows + [(70, None), (71, ""), (72, line(900))]


def test_leaks_against_plain(spark, monkeypatch):
    items, rows = corpus()
    texts, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    expected = plain_leaks(rows, items)
    assert len(expected) > 15
    assert sorted((r.doc_id, r.item_id) for r in D.leaks(texts, known).collect()) == expected
    monkeypatch.setattr(D, "SHARD_WORDS", 150)
    assert sorted((r.doc_id, r.item_id) for r in D.leaks(texts, known).collect()) == expected


def test_passages_fit_the_item_not_its_neighbours(spark):
    rng = random.Random(1)
    line = lambda n, x: " ".join(f"{x}{rng.randint(0, 10 ** 6)}" for _ in range(n))
    q, a = line(20, "q"), line(12, "a")
    texts = spark.createDataFrame([(1, f"{q} {line(1500, 'x')} {a}"), (2, f"{line(50, 'x')} {q} {a}")], "doc_id long, text string")
    short = [(1, f"{q}. {a}.")]
    for items in (short, short + [(2, line(3000, "w"))]):
        assert [(r.doc_id, r.item_id) for r in D.leaks(texts, spark.createDataFrame(items, "item_id long, text string")).collect()] == [(2, 1)]
    assert [D.passage_of(n) for n in (0, 42, 43, 85, 86, 3000)] == [64, 64, 128, 128, 256, 8192]


def test_terms_by_a_mention_are_counted_whole():
    mention = "a@b.co"
    for text in (f"{'x' * 450} two {mention} {'y' * 450} four", f"one {'é' * 5000} three {mention} {' ' * 3000}z", f"{mention}", f"a b c d e f g h {mention} i j k l m n o p"):
        start = text.index(mention)
        words = lambda part: [m for m in P._TERM.findall(part)]
        assert P.terms_before(text, start) == words(text[:start])[-6:]
        assert P.terms_after(text, start + len(mention)) == words(text[start + len(mention):])[:6]


def test_counts_of_disclosing_terms(spark):
    """Joint, total and entity counts by hand: bits of every term that passes."""
    rng = random.Random(2)
    noise = lambda n: " ".join(f"w{rng.randint(0, 40)}" for _ in range(n))
    people = [(f"name{i}", f"mail{i}@host.org") for i in range(40)]
    rows = [f"{noise(5)} {n} {m} {noise(8)}" for n, m in people for _ in range(rng.randint(1, 4))] + [noise(30) for _ in range(30)]
    rows += rows[:10]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    near, total, mentions = Counter(), Counter(w for t in rows for w in t.replace("@", " ").replace(".", " ").split()), Counter()
    texts = {}
    for t in rows:
        mail = next((w for w in t.split() if "@" in w), None)
        if mail:
            w, at = t.split(), t.split().index(mail)
            mentions[mail] += 1
            for x in set(w[max(0, at - 6):at] + w[at + 1:at + 7]):
                if len(x) > 2:
                    near[x, mail] += 1
                    texts.setdefault((x, mail), set()).add(t)
    expected = {}
    for (x, mail), joint in near.items():
        bits = math.log2(joint / total[x] * sum(mentions.values()) / mentions[mail])
        if len(texts[x, mail]) >= 2 and joint >= 0.5 * total[x] and bits >= 3:
            expected[x] = max(expected.get(x, 0), bits)
    got = {r.term: r.bits for r in P.disclosing_terms(docs, bits=3.0).collect()}
    assert len(expected) > 10 and set(got) == set(expected) and all(abs(got[x] - expected[x]) < 1e-9 for x in got)
