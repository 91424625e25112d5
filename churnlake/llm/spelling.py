"""Spelling variants: words of a corpus that differ by one edit, grouped under their commonest form.

1. Words are counted over the whole corpus (combined before the shuffle, so a word that is a third of all runs is one row).
2. The vocabulary fills blocked Bloom filters, one for each word length (lengths of ``LONG`` and more share one). A word
   sets one bit in each of the eight 64-bit cells of one block. There are ``BITS`` bits for a word, and ``MAX_BLOCKS``
   blocks of 64 bytes at most whatever the corpus: beyond that the filters only let more false candidates through. So what
   is broadcast has a fixed bound (``MAX_BLOCKS`` * 64 bytes).
3. Every word probes its one-edit neighbours against the filters, in numpy, from rolling hashes: no string is made for a
   probe. Near pairs are symmetric, so only half is generated: deletions find the longer word's side of an insertion, and
   replacements go to a later character only. Repeated letters would give the same deletion twice; only the first is taken,
   so each pair arises once.
4. What the filters let through is made a string and joined with the vocabulary, which removes the false positives. The
   result does not depend on the filters.
5. The best neighbour is an aggregate per word. Counts at least double from a word to its form, so chains have at most
   log2(largest count) steps; roots are found by doubling along them.

Replacements run over the characters that occur in the vocabulary: the work per word is its length times that number.

Defined results: a null text has no words; repeated rows count as often as they stand there; ties between forms go to the
smaller word in code-point order; an empty table gives an empty result; a word without neighbours is its own root.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import ship_package, staged
from churnlake.llm.textbytes import _powers, mix

#: Runs of letters of the Latin-1 block; only A to Z are lower-cased.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS, MIN_COUNT, RATIO = 5, 3, 2
LONG = 64
CELLS = 8
BITS = 16
MAX_BLOCKS = 1 << 20
PROBES = 1 << 20
_SEED = np.uint64(0xD6E8FEB86659FD93)


def runs_of(text: Column) -> Column:
    """The lower-cased runs of a text, in order."""
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(RUN), F.lit(0)),
                       lambda run: F.translate(run, UPPER, LOWER))


def vocabulary(words: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n of the words (column ``word``) that are long and common enough."""
    counted = words.where(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def _shard(length: Column) -> Column:
    return F.least(length, F.lit(LONG))


def _codes(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), length)


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """(length, row numbers) in portions of at most PROBES characters."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        step = max(1, PROBES // 64 // max(1, length))
        for k in range(0, len(rows), step):
            yield length, rows[k:k + step]


def _terms(codes: np.ndarray, up: np.ndarray) -> np.ndarray:
    """What each character adds to the hash of its word, which is the sum of these."""
    return _char(codes) * up[:codes.shape[1]]


def _char(codes: np.ndarray) -> np.ndarray:
    return mix((codes.astype(np.uint64) + np.uint64(1)) * _SEED)


def _power_table(length: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(10, int(length + 1).bit_length()))


class Filters:
    """Blocked Bloom filters of the lengths in ``blocks``; ``cells`` holds those of all, one after the other."""

    def __init__(self, blocks: dict[int, int], cells: np.ndarray | None = None):
        self.blocks = blocks
        starts = np.cumsum([0, *blocks.values()])
        self.starts = dict(zip(blocks, starts[:-1].tolist()))
        self.cells = np.zeros(int(starts[-1]) * CELLS, np.uint64) if cells is None else cells

    def place(self, length: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Block number, and the hash that picks the bits."""
        spread = mix(hashes)
        shard = min(length, LONG)
        block = ((spread >> np.uint64(32)) * np.uint64(self.blocks[shard])) >> np.uint64(32)
        return block.astype(np.int64) + self.starts[shard], mix(spread ^ _SEED)

    @staticmethod
    def bit(picks: np.ndarray, cell: int) -> np.ndarray:
        return np.uint64(1) << ((picks >> np.uint64(6 * cell)) & np.uint64(63))

    def may_hold(self, length: int, hashes: np.ndarray) -> np.ndarray:
        """Positions of the hashes that may be words of that length."""
        if min(length, LONG) not in self.blocks or not len(hashes):
            return np.zeros(0, np.int64)
        block, picks = self.place(length, hashes)
        left = np.arange(len(hashes))
        for cell in range(CELLS):
            hit = (self.cells[block * CELLS + cell] & self.bit(picks, cell)) != 0
            left, block, picks = left[hit], block[hit], picks[hit]
        return left


def build_filters(words: DataFrame, bits: int = BITS, max_blocks: int = MAX_BLOCKS) -> Filters:
    """The filters of a vocabulary; one row per block comes to the driver, ``max_blocks`` at most and one per length."""
    sizes = {r[0]: r[1] for r in words.groupBy(_shard(F.length("word"))).count().collect()}
    wanted = {k: n * bits / (CELLS * 64) for k, n in sorted(sizes.items())}
    scale = min(1.0, max_blocks / max(1.0, sum(wanted.values())))
    filters = Filters({k: max(1, int(np.ceil(w * scale))) for k, w in wanted.items()})
    blocks = filters.blocks

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shape = Filters(blocks, np.zeros(0, np.uint64))
        for batch in batches:
            names = batch["word"].tolist()
            for length, rows in _by_length(names):
                up, _ = _power_table(length)
                hashes = _terms(_codes([names[i] for i in rows], length), up).sum(axis=1, dtype=np.uint64)
                block, picks = shape.place(length, hashes)
                yield pd.DataFrame({"block": block, **{f"c{k}": Filters.bit(picks, k).view(np.int64) for k in range(CELLS)}})

    cells = [f"c{k}" for k in range(CELLS)]
    filled = words.select("word").mapInPandas(place, "block long, " + ", ".join(f"{c} long" for c in cells)).groupBy("block").agg(
        *[F.bit_or(c).alias(c) for c in cells])
    table = filled.toPandas()
    filters.cells.reshape(-1, CELLS)[table["block"].to_numpy()] = table[cells].to_numpy(np.int64).view(np.uint64)
    return filters


def _edits(codes: np.ndarray, letters: np.ndarray, filters: Filters) -> Iterator[tuple[np.ndarray, int, int]]:
    """(rows, position, letter) of edits that may be words; letter -1 is a deletion. All rows have one length."""
    n, length = codes.shape
    up, down = _power_table(length)
    terms = _terms(codes, up)
    total = terms.sum(axis=1, dtype=np.uint64)
    marks = _char(letters)
    before = np.zeros(n, np.uint64)
    for at in range(length):
        through = before + terms[:, at]
        new = np.arange(n) if at == 0 else np.flatnonzero(codes[:, at] != codes[:, at - 1])
        hit = new[filters.may_hold(length - 1, before[new] + (total[new] - through[new]) * down[1])]
        if len(hit):
            yield hit, at, -1
        row, letter = np.nonzero(letters[None, :] > codes[:, at][:, None])
        hit = filters.may_hold(length, total[row] + marks[letter] * up[at] - terms[row, at])
        for code in np.unique(letter[hit]).tolist():
            yield row[hit[letter[hit] == code]], at, int(letters[code])
        before = through


def candidates(words: DataFrame, filters: Filters) -> DataFrame:
    """word, n, near: edits of every word that the filters let through, each pair of near words in one direction."""
    spark = words.sparkSession
    ship_package(spark)
    characters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct().toPandas()["c"]
    letters = np.array(sorted(map(ord, characters)), np.uint32)
    shared = spark.sparkContext.broadcast((filters.blocks, filters.cells))

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = Filters(*shared.value)
        for batch in batches:
            names, counts = batch["word"].tolist(), batch["n"].to_numpy()
            for length, rows in _by_length(names):
                own, near, size = [], [], 0
                for hit, at, letter in _edits(_codes([names[i] for i in rows], length), letters, held):
                    put = "" if letter < 0 else chr(letter)
                    for i in rows[hit].tolist():
                        word = names[i]
                        own.append(i)
                        near.append(word[:at] + put + word[at + 1:])
                        size += length
                    if size > PROBES:
                        yield pd.DataFrame({"word": [names[i] for i in own], "n": counts[own], "near": near})
                        own, near, size = [], [], 0
                if own:
                    yield pd.DataFrame({"word": [names[i] for i in own], "n": counts[own], "near": near})

    return words.select("word", "n").mapInPandas(probe, "word string, n long, near string")


def near_pairs(words: DataFrame, **settings) -> DataFrame:
    """word, near, near_n: every word with every word that is one edit away, in both directions. ``words`` is written."""
    filters = build_filters(words, **settings)
    if not filters.blocks:
        return words.select("word", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    exact = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    found = candidates(words, filters).join(exact, "near")
    both = F.array(F.struct("word", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    return found.select(F.inline(both))


def _roots(forms: DataFrame) -> DataFrame:
    """word, root of the words that have a form: each round doubles the steps taken."""
    held = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = held.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = staged(held.join(further, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if not moved.where("moved").limit(1).count():
            return moved.select("word", "root")
        held = moved.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, **settings) -> DataFrame:
    """word, form, root, n, n_near, form_n of a vocabulary (word, n)."""
    words = staged(words.select("word", "n"), "spelling-words")
    best = near_pairs(words, **settings).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    judged = staged(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.expr(f"CASE WHEN -best.less >= {ratio} * n THEN best.near END").alias("form"),
        F.expr(f"CASE WHEN -best.less >= {ratio} * n THEN -best.less END").alias("form_n")), "spelling-forms")
    roots = _roots(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
