"""Pieces of byte-level BPE: worked out once whatever stands beside them, together and alone, in any script."""

import random

import public_tokenizers
from tokenizers import Tokenizer

from scriptorium.llm import bpe_tokens

BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_words_are_kept_without_what_stands_beside_them():
    own = bpe_tokens.Encoder(BPE)
    text = "".join(f" zanzibar{a} quixotry{b}" for a in ",.;!?" for b in (":)", "--", "..."))
    assert own.decode(own.encode(text)) == text
    assert {p for p in own.words if "z" in p or "q" in p} == {" zanzibar", " quixotry"}


def test_together_alone_and_by_the_library():
    own, library = bpe_tokens.Encoder(BPE), Tokenizer.from_file(BPE)
    some = random.Random(3)
    letters = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "　", "'", "'s", "'ll", "'S", "0", "12", "é", "ö", "×", "ɐ", "中", "😀", "\0", "!", "ß", "٣", "²", "́", "<|endoftext|>"]
    texts = ["".join(some.choices(letters, k=some.randrange(16))) for _ in range(3000)]
    texts += ["".join(some.choices("abcdefghijklmnopqrstuvwxyzéö", k=n)) for n in (63, 64, 65, 66, 3000)] + ["y" * 5000, " " * 900 + "é" * 40]
    want = [",".join(map(str, library.encode(t, add_special_tokens=False).ids)) for t in texts]
    assert own.encode_all(texts) == want and own.decode_all(want) == texts
    assert [own.encode(t) for t in texts[-600:]] == want[-600:]
    pieces = [p for t in texts[:300] for p in own.pattern.findall(t)]
    assert own.pieces(pieces) == [own.piece(p) for p in pieces]


def test_remembered_pairs_and_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe_tokens, "WORDS", 60)
    monkeypatch.setattr(bpe_tokens, "PAIRS", 5)
    monkeypatch.setattr(bpe_tokens, "PAIR_BITS", 4)
    monkeypatch.setattr(bpe_tokens, "TOGETHER", 7)
    own, library = bpe_tokens.Encoder(BPE), Tokenizer.from_file(BPE)
    for k in range(6):
        text = " ".join(f"the w{i * k} x{i % 30}" for i in range(90)) + " long" * 3 + "er" * 60
        assert own.encode(text) == ",".join(map(str, library.encode(text, add_special_tokens=False).ids))
        assert len(own.words) + len(own.older) <= 60 and len(own.known) == 16 and own.pairs <= 5 + 200
