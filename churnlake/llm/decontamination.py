"""Benchmark decontamination by SimHash over item-sized windows.

Words are lower-cased runs of characters that are not white space. A window of a document has as many words as a benchmark
item; its fingerprint is a 60-bit SimHash in which every word occurrence has a vote. Fingerprints of windows and items
of one size are matched by multi-index Hamming blocks: 60 bits in 20 blocks of 3, so that two fingerprints at most 19
bits apart agree in at least one block, and an equality join on (size, block number, block value) finds every such
pair. A pair is emitted in the first block in which it agrees only, and only if it lies within the radius, so the join
gives each pair once, as two content keys and a distance. Each pair is then verified: the weighted Jaccard similarity of
their five-word shingles, counted as often as they occur, must reach 0.8.

Which windows are fingerprinted: all that hold enough shingles of items of that size, wherever they stand. A window and
an item of m shingles each have similarity 0.8 only if 8/9 of m are common; for a window cut by an end of the document it
is 0.8 of m at least. Windows with fewer shingles of any item of the size are refused without a fingerprint, so none is
lost here that the verification would accept, and the rest of the corpus never leaves the scan. Shingles are compared as
64-bit hashes in a join with the benchmark's shingles. That table has rows of fixed width, which are counted; it is
broadcast up to ``BENCHMARK_ROWS`` and joined by shuffling beyond.

All of it is column expressions and joins. Candidate texts are kept once, by MD5. Windows are places (text, size, first
word) until their words are needed; those are cut from stretches of a text that are as long as the longest item, so that
no row holds the windows of a whole text. Windows with the same words are fingerprinted and verified once, however often a
text, or many documents, repeat them. The work is linear in the length of a text.

Defined results: null and empty texts match nothing; items of fewer than five words have no shingle and match nothing;
null item ids stay null; a document that is shorter than the window, or a window that would reach over an end, is compared
with the words that are there; repeated rows of one id and text give one result for each item; of equally similar
windows those go first that have a shingle at the place where an item has it (moved inwards from the document's ends), then
the nearest fingerprint, then the earliest; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import BROADCAST_ROWS, SHINGLE, let, staged, words_of
from churnlake.sources.staging import handed_out

RADIUS = 19
BLOCKS, BLOCK_BITS = 20, 3
SIMILARITY_PERCENT = 80
BENCHMARK_ROWS = 2_000_000
#: Stretches of a text have at least this many words.
STRETCH = 64


def shingle_hashes(words: Column) -> Column:
    """64-bit hashes of all runs of five words, in order."""
    def runs(h: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(h) - SHINGLE), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(SHINGLE)]))
        return F.when(F.size(h) >= SHINGLE, hashes).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), runs)


def fingerprint(words: Column) -> Column:
    """60-bit SimHash: a bit is set if it is set in the hashes of more than half of the words."""
    hashes = F.transform(words, lambda w: F.conv(F.substring(F.md5(w), 1, 15), 16, 10).cast("long"))

    def bits(h: Column) -> Column:
        def vote(bit: Column) -> Column:
            votes = F.aggregate(h, F.lit(0).cast("long"), lambda a, x: a + F.call_function("shiftright", x, bit).bitwiseAND(F.lit(1)))
            return F.when(2 * votes > F.size(h), F.call_function("shiftleft", F.lit(1).cast("long"), bit)).otherwise(0)
        return F.aggregate(F.sequence(F.lit(0), F.lit(BLOCKS * BLOCK_BITS - 1)), F.lit(0).cast("long"),
                           lambda a, b: a.bitwiseOR(vote(b).cast("long")))

    return let(hashes, bits)


def blocks(print_: Column) -> Column:
    """Block number and value, as an array to explode."""
    return F.array(*[F.struct(
        F.lit(b).alias("block"), F.shiftright(print_, b * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).alias("value"))
        for b in range(BLOCKS)])


def agrees_first_in(block: Column, a: Column, b: Column) -> Column:
    """Whether no block before ``block`` is the same in both fingerprints, given that this one is."""
    apart = a.bitwiseXOR(b)
    before = F.call_function("shiftleft", F.lit(1).cast("long"), block * BLOCK_BITS) - 1
    firsts = F.lit(sum(1 << (k * BLOCK_BITS) for k in range(BLOCKS))).bitwiseAND(before)
    any_bit = apart.bitwiseOR(F.shiftright(apart, 1)).bitwiseOR(F.shiftright(apart, 2))
    return any_bit.bitwiseAND(firsts) == firsts


def told_apart(hashes: Column) -> Column:
    """The hashes, repeated ones renamed by how often they stood before: multisets as sets."""
    def renamed(a: Column) -> Column:
        def nth(x: Column, i: Column) -> Column:
            return let(i + 1 - F.array_position(a, x), lambda k: F.when(k > 0, F.xxhash64(x, k)).otherwise(x))
        return F.transform(a, nth)

    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), hashes).otherwise(let(F.array_sort(hashes), renamed))


def _words(text_col: str) -> Column:
    return words_of(F.lower(F.col(f"`{text_col}`")))


def _content(words: Column) -> Column:
    """A key of the words; none of them holds a space."""
    return F.md5(F.array_join(words, " "))


def prepared_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Items with their size, content key, shingles and fingerprint, written once."""
    cut = items.select(F.col(f"`{id_col}`").alias("item_id"), _words(text_col).alias("words"))
    return staged(
        cut.select("item_id", F.size("words").alias("size"), _content(F.col("words")).alias("item"),
                   shingle_hashes(F.col("words")).alias("item_shingles"), fingerprint(F.col("words")).alias("item_print"))
        .where(F.size("item_shingles") > 0), "bench-items")


def places(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """key (MD5 of a text), n (its words), size, sorted places of shingles of items of that size, and the windows that have
    one where an item has it."""
    wanted = items.select("size", F.posexplode("item_shingles").alias("offset", "wanted")).distinct()
    hashes = docs.select(F.md5(F.col(f"`{text_col}`")).alias("key"), let(_words(text_col), shingle_hashes).alias("hashes"))
    found = hashes.select("key", (F.size("hashes") + (SHINGLE - 1)).alias("n"), F.posexplode("hashes").alias("at", "hash"))
    if wanted.limit(BENCHMARK_ROWS + 1).count() <= BENCHMARK_ROWS:
        wanted = F.broadcast(wanted)
    met = found.join(wanted, F.col("hash") == F.col("wanted"))
    each = met.groupBy("key", "n", "size").agg(
        F.array_sort(F.collect_set("at")).alias("hits"), F.collect_set(F.col("at") - F.col("offset")).alias("aligned"))
    return each.where(F.size("hits") >= _at_least(F.col("size"), 4, 5))


def _at_least(size: Column, part: int, of: int) -> Column:
    """The share ``part / of`` of a window's shingles, rounded up."""
    shingles = size - (SHINGLE - 1)
    return F.floor((part * shingles + of - 1) / of).cast("int")


def starts(hits: Column, size: Column, need: Column) -> Column:
    """First words of all windows that hold ``need`` hits; they may reach over the ends of the document."""
    def span(i: Column) -> Column:
        first, last = F.get(hits, i), F.get(hits, i + need - 1)
        earliest = last - size + SHINGLE
        return F.when(earliest <= first, F.sequence(earliest, F.greatest(earliest, first))).otherwise(F.array().cast("array<int>"))
    spans = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(hits) - need)), span)
    return F.when(F.size(hits) >= need, F.array_distinct(F.flatten(spans))).otherwise(F.array().cast("array<int>"))


def windows(found: DataFrame) -> DataFrame:
    """key, size, first, length, aligned: every window of ``places`` that holds enough shingles, once."""
    size, n = F.col("size"), F.col("n")
    room = n - size

    def window(s: Column, real: bool) -> Column:
        first = F.greatest(F.lit(0), s)
        return F.struct(first.alias("first"), (F.least(n, s + size) - first).alias("length"), F.lit(real).alias("real"))

    inside = F.filter(starts(F.col("hits"), size, _at_least(size, 8, 9)), lambda s: (s >= 0) & (s <= room))
    over = F.filter(starts(F.col("hits"), size, _at_least(size, 4, 5)), lambda s: (s < 0) | (s > room))
    moved = F.transform("aligned", lambda s: window(F.greatest(F.lit(0), F.least(s, room)), False))
    each = found.select("key", "size", F.explode(F.concat(F.transform(F.concat(inside, over), lambda s: window(s, True)), moved)).alias("w"))
    return each.groupBy("key", "size", "w.first", "w.length").agg(
        F.bool_or("w.real").alias("real"), F.bool_or(~F.col("w.real")).alias("aligned")).where("real").drop("real")


def cut_windows(texts: DataFrame, wanted: DataFrame, longest: int) -> DataFrame:
    """``wanted`` windows with their ``words``; ``texts`` has one row per key."""
    step = max(STRETCH, longest)

    def stretches(words: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(words) - 1) / step).cast("int")))
        return F.transform(numbers, lambda c: F.struct(c.alias("stretch"), F.slice(words, c * step + 1, 2 * step).alias("words")))

    parts = texts.select(F.col("key").alias("of"), F.explode(let(words_of(F.lower("text")), stretches)).alias("p"))
    parts = parts.select("of", F.col("p.stretch").alias("part"), "p.words")
    there = wanted.withColumn("stretch", F.floor(F.col("first") / step).cast("int")).groupBy("key", "stretch").agg(
        F.collect_list(F.struct("size", "first", "length", "aligned")).alias("ws"))
    met = there.join(parts, (F.col("key") == F.col("of")) & (F.col("stretch") == F.col("part")))
    each = met.select("key", F.explode(F.transform("ws", lambda w: F.struct(
        w["size"].alias("size"), w["first"].alias("first"), w["aligned"].alias("aligned"),
        F.slice("words", w["first"] - F.col("stretch") * step + 1, w["length"]).alias("words")))).alias("w"))
    return each.select("key", "w.*")


def near_pairs(prints: DataFrame, items: DataFrame, radius: int = RADIUS) -> DataFrame:
    """window, item, hamming: fingerprints of one size within the radius, each pair once. Both sides have one row per content."""
    left = prints.select("size", "window", "print", F.explode(blocks(F.col("print"))).alias("b")).select(
        "size", "window", "print", "b.block", "b.value")
    right = staged(items.select("size", "item", "item_print", F.explode(blocks(F.col("item_print"))).alias("b")).select(
        F.col("size").alias("item_size"), "item", "item_print", F.col("b.block").alias("item_block"),
        F.col("b.value").alias("item_value")), "bench-blocks")
    hamming = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    met = left.join(handed_out(right), (F.col("size") == F.col("item_size")) & (F.col("block") == F.col("item_block"))
                    & (F.col("value") == F.col("item_value")) & (hamming <= radius)
                    & agrees_first_in(F.col("block"), F.col("print"), F.col("item_print")))
    return met.select("window", "item", hamming.alias("hamming"))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 radius: int = RADIUS) -> DataFrame:
    """id, key, item_id, start, n_words, hamming, similarity: the best window of every document and item that match."""
    if radius >= BLOCKS:
        raise ValueError(f"{BLOCKS} blocks guarantee a radius of {BLOCKS - 1} at most")
    bench = prepared_items(items)
    unique = staged(bench.drop("item_id").dropDuplicates(["item"]).withColumn("item_shingles", told_apart(F.col("item_shingles"))),
                    "bench-contents")
    longest = unique.agg(F.max("size")).first()[0] or 0
    found = staged(places(docs, bench, text_col), "bench-places")
    keys = staged(found.select(F.col("key").alias("of")).distinct(), "bench-keys")
    here = staged(docs.select(
        F.col(f"`{id_col}`").alias("id"), F.md5(F.col(f"`{text_col}`")).alias("key"), F.col(f"`{text_col}`").alias("text"))
        .join(handed_out(keys), F.col("key") == F.col("of"), "left_semi"), "bench-candidates")
    texts = here.groupBy("key").agg(F.first("text").alias("text"))
    cut = staged(cut_windows(texts, windows(found), longest).withColumn("window", _content(F.col("words"))), "bench-windows")
    prints = staged(cut.groupBy("size", "window").agg(F.first("words").alias("words")).select(
        "size", "window", told_apart(shingle_hashes(F.col("words"))).alias("shingles"), fingerprint(F.col("words")).alias("print")),
        "bench-prints")
    pairs = near_pairs(prints, unique, radius)
    common = F.size(F.array_intersect("shingles", "item_shingles"))
    similar = staged(
        pairs.join(prints.select("size", F.col("window").alias("w"), "shingles"), F.col("window") == F.col("w"))
        .join(handed_out(unique.select(F.col("item").alias("i"), F.col("size").alias("item_size"), "item_shingles")),
              (F.col("item") == F.col("i")) & (F.col("size") == F.col("item_size")))
        .withColumn("common", common).withColumn("total", F.size("shingles") + F.size("item_shingles") - F.col("common"))
        .where(100 * F.col("common") >= SIMILARITY_PERCENT * F.col("total"))
        .select(F.col("window").alias("w"), F.col("size").alias("item_size"), "item", "hamming",
                (F.col("common") / F.col("total")).alias("similarity")), "bench-similar")
    first = cut.groupBy("key", "size", "window").agg(F.max(F.struct("aligned", (-F.col("first")).alias("early"))).alias("at"))
    best = staged(
        first.join(handed_out(similar), (F.col("window") == F.col("w")) & (F.col("size") == F.col("item_size")))
        .join(handed_out(bench.select("item_id", F.col("item").alias("i")).distinct()), F.col("item") == F.col("i"))
        .groupBy(F.col("key").alias("of"), "item_id").agg(F.max(F.struct(
            "similarity", "at.aligned", (-F.col("hamming")).alias("near"), "at.early", "size")).alias("b")), "bench-best")
    return here.select("id", "key").distinct().join(handed_out(best), F.col("key") == F.col("of")).select(
        F.col("id").alias(id_col), "key", "item_id", (-F.col("b.early")).alias("start"), F.col("b.size").alias("n_words"),
        (-F.col("b.near")).alias("hamming"), "b.similarity")


def clean_documents(docs: DataFrame, items: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """The documents without a match, unchanged."""
    found = staged(contaminated(docs, items, text_col=text_col, **settings).select("key").distinct(), "bench-found")
    if found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    return docs.join(found, F.md5(docs[f"`{text_col}`"]) == found["key"], "left_anti")
