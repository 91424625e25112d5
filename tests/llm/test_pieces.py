"""Ids of texts that are cut into pieces equal the ids that the tokenizer gives for the whole texts."""

import random

import numpy as np

from churnlake.llm import token_blocks
from churnlake.llm.queries import tokenizer_file

SPACES = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", " ", " ", " ", " ", " ", "　"]
WORDS = ["a", "Word", "12", "été", "ÿ", "Ã", "×", "÷", "ª", "½", "_", "漢字", "かな", "Привет", "😀", "é", "​", "᠎", "\x00", "\x7f"]
MARKS = ["'", "'s", "'re", "'LL", ".", "...", ",", "!?", "$$$", "“", "—", "«", "<b>", "&amp;", "|", "endoftext"]


def whole(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file())
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def collected(texts):
    out = [[] for _ in texts]
    for row, ids, last in token_blocks.encoded(texts, tokenizer_file()):
        out[row] += ids.tolist()
        assert not last or ids[-1] == 0
    return out


def test_any_mixture_of_words_marks_and_spaces():
    rng = random.Random(5)
    texts = ["", "\n", " ", "", "x"]
    for parts in (SPACES[:3] + WORDS[:4] + MARKS, SPACES + WORDS, SPACES + WORDS + MARKS, SPACES[:2] + WORDS + MARKS):
        texts += ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(4_000)]
    assert collected(texts) == [[*ids, 0] for ids in whole(texts)]


def test_every_character_between_others():
    texts = [a + chr(c) + b for c in [*range(0xD800), *range(0xE000, 0x11000)] for a, b in (("a ", " b"), ("a.", "\nb"))]
    assert collected(texts) == [[*ids, 0] for ids in whole(texts)]


def test_long_texts_come_in_parts_and_tables_change(monkeypatch):
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdeé,.", k=rng.randint(1, 9))) for _ in range(30_000)]
    texts = [" ".join(rng.choices(words, k=200_000)), "y" * 700_000, ", ".join(words)]
    monkeypatch.setattr(token_blocks, "SEGMENT", 100_000)
    monkeypatch.setattr(token_blocks, "CACHE", 5_000)
    found = collected(texts)
    assert found == [[*ids, 0] for ids in whole(texts)]


def test_equal_hashes_of_different_pieces(monkeypatch):
    monkeypatch.setattr(token_blocks, "run_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64) // 3)
    texts = ["one two six, ten. two one", "", "ten\nsix six"]
    assert collected(texts) == [[*ids, 0] for ids in whole(texts)]
