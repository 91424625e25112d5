"""Decontamination of long texts that repeat an item, and of one passage in very many documents."""

import random
import time
from collections import Counter

from pyspark.sql import functions as F

from churnlake.llm import decontamination


def test_a_long_text_that_repeats_an_item(spark):
    """100,000 words: only as many windows are fingerprinted as there are different ones."""
    rng = random.Random(11)
    item = [f"w{rng.randrange(10**6)}" for _ in range(40)]
    items = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(item[::-1]))], "item_id long, text string")
    docs = spark.createDataFrame([(7, " ".join(item * 2500)), (8, " ".join(item[20:] + item[:20])), (9, "other words")],
                                 "doc_id long, text string")
    begun = time.time()
    found = {(r.doc_id, r.item_id): (r.start, r.hamming, r.similarity) for r in decontamination.contaminated(docs, items).collect()}
    assert found[7, 1] == (0, 0, 1.0) and set(found) == {(7, 1), (8, 1)}
    assert time.time() - begun < 60
    bench = decontamination.prepared_items(items)
    cut = decontamination.windows(decontamination.places(docs, bench))
    assert cut.count() < 2 * 100_000


def test_one_passage_in_many_documents(spark):
    rng = random.Random(12)
    item = " ".join(f"w{rng.randrange(10**6)}" for _ in range(30))
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("head"), F.col("id").cast("string"), F.lit(f" {item} tail"), (F.col("id") % 7).cast("string")).alias("text"))
    items = spark.createDataFrame([(1, item), (1, item), (2, item), (3, None)], "item_id long, text string")
    found = decontamination.contaminated(docs, items)
    rows = found.groupBy("item_id", "start", "similarity").count().collect()
    assert {tuple(r) for r in rows} == {(1, 1, 1.0, 4000), (2, 1, 1.0, 4000)}


def test_multisets_as_sets(spark):
    rng = random.Random(13)
    rows = [(i, [rng.randrange(6) for _ in range(rng.randrange(9))], [rng.randrange(6) for _ in range(rng.randrange(9))]) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, a array<bigint>, b array<bigint>")
    common = F.size(F.array_intersect(decontamination.told_apart(F.col("a")), decontamination.told_apart(F.col("b"))))
    found = {r.i: r.n for r in df.select("i", common.alias("n")).collect()}
    assert found == {i: sum((Counter(a) & Counter(b)).values()) for i, a, b in rows}


def test_pairs_come_once(spark):
    """Every pair within the radius, in one block only."""
    rng = random.Random(14)
    near = [rng.getrandbits(60) for _ in range(40)]
    prints = [(5, f"w{k}", near[k % 40] ^ sum(1 << b for b in rng.sample(range(60), rng.randrange(28)))) for k in range(200)]
    items = [(5 + (k == 39), f"i{k}", p) for k, p in enumerate(near)]
    found = decontamination.near_pairs(
        spark.createDataFrame(prints, "size int, window string, print long"),
        spark.createDataFrame(items, "size int, item string, item_print long")).collect()
    expected = {(w, i, (p ^ q).bit_count()) for s, w, p in prints for t, i, q in items if s == t and (p ^ q).bit_count() <= 19}
    assert len(found) == len(expected) and {tuple(r) for r in found} == expected
