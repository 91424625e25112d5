"""Texts with the literal text of an added token have the ids that the tokenizer file gives for the whole text."""

import random

from churnlake.llm import token_blocks
from churnlake.llm.queries import tokenizer_file


def test_added_tokens():
    from tokenizers import Tokenizer

    rng, tokenizer = random.Random(2), Tokenizer.from_file(tokenizer_file())
    parts = [" ", "  ", "\n", "a", "bc", "!", "<|endoftext|>", " x<|endoftext|>", "<|endof", "text|>"]
    texts = ["<|endoftext|>", "a <|endoftext|> b", *["".join(rng.choices(parts, k=rng.randint(0, 20))) for _ in range(1_000)]]
    for text, (_, ids, _) in zip(texts, token_blocks.encoded(texts, tokenizer_file())):
        assert ids[:-1].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert next(token_blocks.encoded(["<|endoftext|>"], tokenizer_file()))[1].tolist()[0] == 50256
