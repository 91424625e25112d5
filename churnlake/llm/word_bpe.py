"""Byte-pair encoding with word ends: merges from a priority queue over a doubly linked symbol list, and decoding.

The tokenizer file gives the rules: text normalisation, the pattern that finds words, the vocabulary and the merges by
rank. A word is the list of its bytes as symbols, the last one marked as a word end. Neighbours that can merge are queued
by (rank, position); the first of the queue merges, its neighbours are queued anew, and an entry whose symbols have changed
since it was queued is stale and skipped. That is n log n steps for a word of n bytes, however long it is.

Each distinct word is merged once per worker and then kept, in a table that is emptied when it holds ``CACHE`` words.
Texts are independent rows: there is no shuffle, and nothing grows with the table.

Words are found by Python's own Unicode tables where these agree with the library's (``_KNOWN``); a text with any other
character is normalised and cut by the library, whose tables are of another Unicode version.

Defined results: a null or empty text has no ids and decodes to the empty text; rows are encoded one by one, so repeated
and null ids stay as they are; only the named columns are read, so that other columns cannot clash; the texts of added
tokens are found before normalisation, as the library does; an empty table gives an empty result; ids that are not in the
vocabulary are an error when decoding.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import ship_package

CACHE = 400_000
#: Characters whose class, case and composition are the same in all Unicode versions in use.
_KNOWN = re.compile(r"[\u0000-ԯḀ-῿‐-⁤₠-₿←-⏿─-➿"
                    r"　-〿ぁ-ゖ゙-ヿ一-鿿가-힣\U0001F300-\U0001F64F]*")


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself where it is printable, else the next one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(others)) for b in range(256)]


def merged(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The symbols after all merges, lowest rank first and leftmost first within a rank."""
    size = len(symbols)
    if size < 2:
        return symbols
    symbols = list(symbols)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    queue = []
    for at in range(size - 1):
        found = merges.get((symbols[at], symbols[at + 1]))
        if found:
            queue.append((found[0], at, found[1]))
    heapq.heapify(queue)
    while queue:
        _, at, new = heapq.heappop(queue)
        right = after[at]
        if symbols[at] < 0 or right >= size:
            continue  # stale: the symbol was merged away, or it is the last one now
        found = merges.get((symbols[at], symbols[right]))
        if not found or found[1] != new:
            continue  # stale: the symbols are others now
        symbols[at], symbols[right] = new, -1
        after[at] = further = after[right]
        left = before[at]
        if further < size:
            before[further] = at
            found = merges.get((new, symbols[further]))
            if found:
                heapq.heappush(queue, (found[0], at, found[1]))
        if left >= 0:
            found = merges.get((symbols[left], new))
            if found:
                heapq.heappush(queue, (found[0], left, found[1]))
    return [s for s in symbols if s >= 0]


class WordCoder:
    """Ids of texts and texts of ids, by the rules of one tokenizer file."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        model, steps = rules["model"], rules["normalizer"]["normalizers"]
        cutter, symbols = rules["pre_tokenizer"]["pretokenizers"]
        if (model["type"], model.get("continuing_subword_prefix") or "", cutter["type"], cutter["invert"], symbols["type"]) != \
                ("BPE", "", "Split", True, "ByteLevel") or [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{path} is not a byte-pair encoder with word ends")
        vocabulary, ending = model["vocab"], model["end_of_word_suffix"]
        bytes_ = byte_symbols()
        self.inner = [vocabulary[c] for c in bytes_]
        self.last = [vocabulary[c + ending] for c in bytes_]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = {(vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b]) for rank, (a, b) in enumerate(pairs)}
        added = {t["content"]: t["id"] for t in rules["added_tokens"]}
        self.added = {text: np.array([i], "<i4").tobytes() for text, i in added.items()}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        pattern = cutter["pattern"]["Regex"]
        self.words = regex.compile(pattern).findall
        self.normalizer = Tokenizer.from_file(path).normalizer
        self.cutter = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        texts = {i: t for t, i in {**vocabulary, **added}.items()}
        self.texts = pa.array([texts.get(i) for i in range(max(texts) + 1)], pa.string())
        self.known: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        """The words of a text without added tokens."""
        if text.isascii():
            return self.words(text.lower())
        if _KNOWN.fullmatch(text):  # one character at a time: the case of a letter does not depend on its neighbours
            return self.words("".join(map(str.lower, unicodedata.normalize("NFC", text))))
        return [piece for piece, _ in self.cutter.pre_tokenize_str(self.normalizer.normalize_str(text))]

    def word(self, word: str) -> bytes:
        data = word.encode("utf-8", "surrogatepass")
        symbols = [self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]
        return np.array(merged(symbols, self.merges), "<i4").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 32-bit integers."""
        if self.special and "<" in text and self.special.search(text):
            parts = self.special.split(text)  # text, added token, text, ...
            return b"".join(self.added[p] if k % 2 else self._encode(p) for k, p in enumerate(parts))
        return self._encode(text)

    def _encode(self, text: str) -> bytes:
        words = self.pieces(text)
        found = list(map(self.known.get, words))
        if None in found:
            for k, ids in enumerate(found):
                if ids is None:
                    word = words[k]
                    ids = self.known.get(word)
                    if ids is None:
                        if len(self.known) >= CACHE:
                            self.known.clear()
                        ids = self.known[word] = self.word(word)
                    found[k] = ids
        return b"".join(found)

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The text of every list: the vocabulary's strings, a space between two."""
        flat = ids.flatten()
        if len(flat) and (pc.min(flat).as_py() < 0 or pc.max(flat).as_py() >= len(self.texts)):
            raise ValueError("an id is outside the vocabulary")
        words = self.texts.take(flat)
        if words.null_count:
            raise ValueError("an id is not in the vocabulary")
        lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words), " ")


@functools.cache
def coder(path: str) -> WordCoder:
    return WordCoder(path)


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (array of int) of every row."""
    ship_package(docs.sparkSession)
    ready = docs.select(F.col(f"`{id_col}`").alias(id_col), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = coder(tokenizer)
        for batch in batches:
            found = [rules.encode(text.as_py()) for text in batch.column(1)]
            ends = np.cumsum([0, *[len(f) // 4 for f in found]])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4")))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[id_col, "ids"])

    return ready.mapInArrow(run, f"`{id_col}` {ready.schema[0].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id, ids, text: the text that the ids stand for, word ends included."""
    ship_package(encoded.sparkSession)
    ready = encoded.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{ids_col}`").cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = coder(tokenizer)
        for batch in batches:
            ids = batch.column(1)
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, rules.decode(ids)], names=[id_col, "ids", "text"])

    return ready.mapInArrow(run, f"`{id_col}` {ready.schema[0].dataType.simpleString()}, ids array<int>, text string")


def digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256 and decoded_sha256 of every row, from the encoded and decoded texts."""
    both = decode(encode(docs, tokenizer, id_col, text_col), tokenizer, id_col)
    return both.select(id_col, F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("text", 256).alias("decoded_sha256"))
