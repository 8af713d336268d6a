"""The compiled transducer: states are few, transitions exact, memory bounded."""

import random

import public_tokenizers
import pytest
import sentencepiece

from scriptorium.llm import token_counts as T

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def made(n, seed=0):
    rng = random.Random(seed)
    parts = ["th", "er", "tion", "▁", " ", "  ", "ing", "é", "日本", "ß", "a", "aa", "123", "0", "…", "\n", "x", "\U0001f600", "ñ", "http", "://", "ii", "II", "\x00"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_counts_of_made_up_words(library):
    own = T.Transducer(PATH)
    for t in made(3000):
        assert own.count(t) == len(library.encode(t)), t


def test_every_piece_and_pair(library):
    """Pieces by themselves, and what merging keeps apart."""
    own, rng = T.Transducer(PATH), random.Random(1)
    pieces = [p for p in own.score if T.MARK not in p]
    for p in rng.sample(pieces, 4000):
        assert own.count(p) == len(library.encode(p))
    for a, b in zip(rng.sample(pieces, 3000), rng.sample(pieces, 3000)):
        assert own.count(a + b) == len(library.encode(a + b))


def test_long_runs_need_few_states():
    own = T.Transducer(PATH)
    own.count("ab" * 20_000)
    small = len(own.arcs)
    own.count("ab" * 40_000)
    assert len(own.arcs) == small < 200


def test_states_built_anew(library, monkeypatch):
    monkeypatch.setattr(T, "STATES", 50)
    monkeypatch.setattr(T, "CHUNK", 7)
    own = T.Transducer(PATH)
    for t in made(400, 3):
        assert own.count(t) == len(library.encode(t))


def test_transitions_depend_on_the_state_alone():
    """Two ways into a state go on alike, letter by letter."""
    own, rng = T.Transducer(PATH), random.Random(4)
    ways: dict[int, list[str]] = {}
    for t in made(600, 5):
        state = 0
        for i, c in enumerate((" " + t).replace(" ", T.MARK)):
            state = (own.arcs[state].get(c) or own.extend(state, c))[0]
            ways.setdefault(state, []).append((" " + t)[:i + 1].replace(T.MARK, " "))
    other = T.Transducer(PATH)
    for state, prefixes in ways.items():
        some = rng.sample(prefixes, min(3, len(prefixes)))
        more = "tioning" if state % 2 else "er the"
        assert len({other.middle(p + more) - other.middle(p) for p in some}) == 1
