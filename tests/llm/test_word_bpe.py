"""Ids and decoded texts are those of the tokenizers library."""

import hashlib

import pytest
from pyspark.sql import functions as F

from churnlake.llm import word_bpe
from churnlake.llm.queries import QUERIES, tokenizer_file


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def test_query(spark, folder, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op11_word_bpe"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids, text = expected(library, texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(text))


TEXTS = [
    "", " \t\n", "Hello  World's it's I'LL we'd", "été naïve ÇA Straße İstanbul ΣΑΣ σας", "été Å", "漢字かな交じり文 한국어 😀👍🏽",
    "a<|endoftext|>b <|startoftext|><|startoftext|>", "<|endoftext", "x1234567890 3.14 ½ ² ١٢", "a b c​d﻿e", "\x00\x01 \x7f",
    "ॐ नमस्ते ไทย עברית العربية", "\U0003fc3c Ᲊ Ƛ֋", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "!!!??? --- '''s 'S",
    "thethethethe ininin abababab", "x" * 3000 + "yz" * 3000, "Ǆ ǅ ﬁ ẞ ẞ K Å",
]


def test_texts_and_decoding(spark, library):
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(TEXTS)] + [(None, None, "y")], "doc_id long, text string, ids string")
    both = word_bpe.decode(word_bpe.encode(docs, tokenizer_file("word_bpe_49k.json")), tokenizer_file("word_bpe_49k.json"))
    found = {r.doc_id: (r.ids, r.text) for r in both.collect()}
    assert found[None] == ([], "")
    for k, text in enumerate(TEXTS):
        assert found[k] == expected(library, text), text[:40]


def test_characters_taken_for_known(library):
    """Every character that is not left to the library gives the library's words."""
    coder = word_bpe.WordCoder(tokenizer_file("word_bpe_49k.json"))
    known = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and word_bpe._KNOWN.fullmatch(chr(c))]
    assert len(known) > 30_000
    for start in range(0, len(known), 500):
        text = " ".join(f"a{c}b" for c in known[start:start + 500])
        assert coder.pieces(text) == [p for p, _ in coder.cutter.pre_tokenize_str(coder.normalizer.normalize_str(text))]


def test_random_words(library):
    import random

    coder, luck = word_bpe.WordCoder(tokenizer_file("word_bpe_49k.json")), random.Random(5)
    for _ in range(3000):
        text = "".join(luck.choice("abcdeinorstéüß'") for _ in range(luck.randint(1, 25)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert list(memoryview(coder.encode(text)).cast("i")) == ids


def test_full_table_of_known_words(monkeypatch, library):
    monkeypatch.setattr(word_bpe, "CACHE", 3)
    coder = word_bpe.WordCoder(tokenizer_file("word_bpe_49k.json"))
    text = "one two three four five one six two seven"
    assert list(memoryview(coder.encode(text)).cast("i")) == library.encode(text, add_special_tokens=False).ids


def test_edges(spark, edge_docs, no_docs):
    path = tokenizer_file("word_bpe_49k.json")
    assert word_bpe.digests(no_docs, path).collect() == []
    rows = word_bpe.digests(edge_docs, path).collect()
    assert len(rows) == edge_docs.count() and sum(r.n_tokens == 0 for r in rows) == 5
    named = edge_docs.select(F.col("text").alias("doc_id"), F.col("doc_id").alias("text"))
    assert word_bpe.encode(named, path, "text", "doc_id").count() == edge_docs.count()
    with pytest.raises(Exception, match="vocabulary"):
        word_bpe.decode(spark.createDataFrame([(1, [99999999])], "doc_id long, ids array<int>"), path).collect()
