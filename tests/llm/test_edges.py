"""Nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

import random

import numpy as np
import pytest

from churnlake.llm import (
    decontamination,
    html_text,
    language_id,
    license_scan,
    mixing,
    near_duplicates,
    placement,
    quality_rules,
    suffix_dedup,
    textbytes,
    token_blocks,
)
from churnlake.llm.queries import tokenizer_file

ITEM = "alpha beta gamma delta epsilon zeta eta theta"


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, ITEM), (None, "too short"), (3, None)], "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (5, None), (7, 1), (7, 0)], "doc_id long, quality int")


def test_decontamination(edge_docs, no_docs, items):
    found = decontamination.contaminated(edge_docs, items).collect()
    assert [(r.doc_id, r.item_id, r.start, r.similarity) for r in found] == [(1, 1, 0, 1.0)]
    clean = decontamination.clean_documents(edge_docs, items)
    assert clean.count() == edge_docs.count() - 2 and clean.columns == edge_docs.columns
    assert decontamination.contaminated(no_docs, items).count() == 0
    assert decontamination.contaminated(edge_docs, items.limit(0)).count() == 0


def test_hamming_blocks_cover_the_radius():
    rng = random.Random(5)
    for _ in range(500):
        apart = rng.sample(range(60), decontamination.RADIUS)
        assert len({b // decontamination.BLOCK_BITS for b in apart}) < decontamination.BLOCKS


def test_language(edge_docs, no_docs):
    rows = {r.doc_id: r for r in language_id.identify(edge_docs).collect() if r.doc_id not in (None, 1, 3)}
    assert rows[2].lang_pred == "und" and rows[6].lang_pred == "und" and rows[5].lang_pred != "und"
    assert language_id.identify(edge_docs).count() == edge_docs.count()
    assert language_id.identify(no_docs).count() == 0


def test_long_text_is_scored_in_pieces_with_the_same_sum():
    rng = np.random.default_rng(1)
    table = rng.normal(size=(2, (1 << language_id.BITS) + 1)).astype(np.float32)
    text = "".join(rng.choice(list("abcdé "), 5_000))
    whole = language_id.score_texts([text], table)
    size, language_id.PIECE = language_id.PIECE, 10_000
    try:
        assert np.allclose(language_id.score_texts([text, "", "x"], table)[0], whole[0], rtol=1e-3)
    finally:
        language_id.PIECE = size


def test_license(spark, edge_docs, no_docs):
    assert license_scan.scan(edge_docs).count() == 0 and license_scan.scan(no_docs).count() == 0
    wrapped = license_scan.SENTENCES["mit-grant"].replace(" furnished ", "\nfurnished ") + ":\n\n" + license_scan.SENTENCES["mit-notice"]
    rows = [(1, wrapped + "."), (2, license_scan.SENTENCES["mit-notice"] + ".\n" + license_scan.SENTENCES["mit-grant"] + "."),
            (3, "x.\nReleased under the MIT License."), (None, "All rights reserved")]
    found = {(r.doc_id, r.rule) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {(1, "mit-full"), (3, "mit-short"), (None, "reserved")}
    import re
    assert all(re.search(license_scan.HINT, s) for s in license_scan.SENTENCES.values())


def test_token_blocks(spark, edge_docs, no_docs):
    rows = token_blocks.token_table(edge_docs, tokenizer_file()).orderBy("start").collect()
    assert len(rows) == edge_docs.count() and [r.doc_id for r in rows][:2] == [None, None]
    assert [r.start for r in rows] == list(np.cumsum([0, *[r.n_tokens for r in rows]])[:-1])
    assert token_blocks.token_table(no_docs, tokenizer_file()).count() == 0


def test_pieces_give_the_ids_of_the_whole_text():
    rng, parts = random.Random(1), [" ", "  ", "\n", "\t", "a", "bc", "'s", "12", "!", "é", " ", "　", "漢", "\r\n", " "]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(2_000)]
    tokenizer = token_blocks.encoder(tokenizer_file()).tokenizer
    for text, (_, ids, _) in zip(texts, token_blocks.encoded(texts, tokenizer_file())):
        assert ids[:-1].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("top", [0, 1, 200, 50_000, 2**32 - 1])
def test_blocks_round_trip(top):
    ids = np.random.default_rng(top % 97).integers(0, top + 1, 4_096).astype(np.uint32)
    ids[5] = top
    data = token_blocks.pack_block(ids, 90)
    back, size = token_blocks.unpack_block(memoryview(data + b"more"))
    assert (back == ids).all() and size == len(data)


def test_html(spark):
    chrome = "<div id=x>Home page About our company Contact the team Careers</div>"
    article = "<article><h1>Title &amp; more</h1><p>one\n two<br>three<aside>no</aside><p class='comment'>no</p><div class=ad>no</div></article>"
    rows = [(i, f"http://h.example/{i}", f"<body>{chrome}<p>own {' '.join(f'w{i}x{k}' for k in range(9))}</p></body>") for i in range(5)]
    rows += [(10, "http://h.example/a", f"<nav>no</nav><header>no</header>{article}<form>no</form><footer>no</footer>"),
             (11, None, None), (None, "odd", ""), (12, "http://h.example/c", "<article><p>cut &amp; of<p clas"), (12, "u", "<p>x"), (12, "u", "<p>x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for group in (1_000, 2):
        found = {(r.page_id, r.url): r.text for r in html_text.extract(pages, group=group).collect()}
        assert all(found[(i, f"http://h.example/{i}")].startswith(f"own w{i}x0") for i in range(5))
        assert not any("Home" in t for t in found.values())
        assert found[(10, "http://h.example/a")] == "Title & more\none two three"
        assert found[(12, "http://h.example/c")] == "cut & of" and found[(11, None)] == "" and found[(12, "u")] == "x"
    assert html_text.extract(pages).count() == len(rows) and html_text.extract(pages.limit(0)).count() == 0


def test_near_duplicates(edge_docs, no_docs):
    rows = near_duplicates.class_table(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert sorted((r.doc_id, r.class_id, r.n_docs) for r in rows if r.doc_id in (1, 2, 3)) == [
        (1, 1, 2), (1, 1, 2), (2, 2, 1), (3, 3, 2), (3, 3, 2)]
    left = near_duplicates.one_of_each(edge_docs)
    assert left.count() == edge_docs.count() - 2 and left.columns == edge_docs.columns
    assert near_duplicates.class_table(no_docs).count() == 0 and near_duplicates.one_of_each(no_docs).count() == 0


def test_group_of_edited_copies(spark):
    """Copies with more and more edits: exactly those near enough to another are linked."""
    from test_queries import brute_classes

    rng, base = random.Random(3), [f"b{i}" for i in range(120)]
    docs = {}
    for i in range(60):
        words = list(base)
        for k in rng.sample(range(120), i % 7):
            words[k] = f"e{i}_{k}"
        docs[i] = " ".join(words)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in near_duplicates.class_table(df).collect()}
    assert found == brute_classes(docs)


def test_signatures_estimate_weighted_jaccard():
    rng = random.Random(2)
    a = [rng.choice("abc") for _ in range(300)]
    b = a[:250] + [rng.choice("abc") for _ in range(50)]
    owner, hashes, counts = textbytes.shingle_counts([" ".join(a).encode(), " ".join(b).encode()], 3)
    left, right = ({int(h): int(c) for o, h, c in zip(owner, hashes, counts) if o == k} for k in (0, 1))
    common = sum(min(c, right.get(h, 0)) for h, c in left.items())
    true = common / (sum(left.values()) + sum(right.values()) - common)
    signature = near_duplicates.signatures(owner, hashes, counts, 2, 4_000)
    assert max(counts) > 8 and abs((signature[0] == signature[1]).mean() - true) < 0.04


def test_quality(edge_docs, no_docs, labels):
    rows = quality_rules.judge(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count()
    assert {r.id: r.kept for r in rows if r.id in (1, 2, 3, 6)} == {1: True, 2: False, 3: False, 6: False}
    kept = quality_rules.kept_documents(edge_docs, labels)
    assert kept.columns == edge_docs.columns and {r.doc_id for r in kept.collect()} == {1, 5}
    assert quality_rules.judge(no_docs, labels).count() == 0
    assert quality_rules.judge(edge_docs, labels.limit(0)).count() == edge_docs.count()


def test_cutoffs_are_earned(spark):
    """Symbols separate good from bad in one stratum; the other has too few labels for any rule."""
    def text(i, symbols):
        return " ".join(f"w{i}x{k}" + ("#" if k < symbols else "") for k in range(20))
    rows = [(i, text(i, 15 if i % 5 == 0 else 0), "en" if i < 1_500 else "fr") for i in range(1_600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(1_600)], "doc_id long, quality int")
    kept = {r.id: r.kept for r in quality_rules.judge(docs, labels).collect()}
    assert all(kept[i] == (i % 5 != 0) for i in range(1_500)) and all(kept[i] for i in range(1_500, 1_600))


def test_binomial_bound(spark):
    from math import comb

    from pyspark.sql import functions as F
    for n, alpha, delta in ((50, 0.1, 0.05), (700, 0.01, 0.003), (100, 0.01, 0.01)):
        tail, best = 0.0, -1
        for k in range(n):
            tail += comb(n, k) * alpha**k * (1 - alpha) ** (n - k)
            if tail > delta:
                break
            best = k
        row = spark.range(1).select(quality_rules.allowed_losses(F.lit(n), alpha, F.lit(delta)).alias("k")).first()
        assert row.k == best


def test_suffix_dedup(edge_docs, no_docs):
    rows = suffix_dedup.removed(edge_docs).collect()
    assert len(rows) == edge_docs.count() and all(r.n_removed == 0 for r in rows)
    doubled = suffix_dedup.removed(edge_docs.unionByName(edge_docs), with_text=True).where("doc_id = 5").collect()
    assert [(r.n_removed == r.n_bytes, r.n_spans, r.kept) for r in doubled] == [(True, 1, "")] * 2
    assert suffix_dedup.removed(no_docs).count() == 0


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(4)
    data = np.frombuffer(bytes(rng.choice([97, 98], 3_000).astype(np.uint8)) + b"ab" * 300, np.uint8)
    text = data.tobytes()
    order = suffix_dedup.suffix_order(data)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    found = suffix_dedup.common_prefixes(data, order, 200)
    for p in range(1, len(text), 17):
        a, b = text[order[p - 1]:], text[order[p]:]
        same = next((k for k in range(min(len(a), len(b), 200)) if a[k] != b[k]), min(len(a), len(b), 200))
        assert found[p] == same


def test_mixing(edge_docs, no_docs):
    rows = mixing.mix(edge_docs).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.taken <= 3 * r.size for r in rows)
    total = sum(r.size for r in rows)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert sum(r.taken for r in own) == int(own[0].target) and own[0].target <= 3 * own[0].source_size
    assert total == sum(r.size for r in mixing.mix(edge_docs).collect())
    assert mixing.mixed_documents(edge_docs).columns == edge_docs.columns
    assert mixing.mix(no_docs).count() == 0


def test_sharding(spark, edge_docs, no_docs):
    shards = placement.named_shards(spark, 8)
    before = {r.slot: r.shard for r in placement.lookup_table(shards, 499).collect()}
    assert sorted(before) == list(range(499))
    sizes = np.bincount([int(s[-1]) for s in before.values()])
    assert sizes.max() - sizes.min() <= 1
    after = {r.slot: r.shard for r in placement.lookup_table(placement.named_shards(spark, 9), 499).collect()}
    assert sum(before[s] != after[s] for s in before) < 499 * 0.3
    placed = placement.place(edge_docs, "doc_id", shards, 499)
    assert placed.count() == edge_docs.count() and placed.where("shard IS NULL").count() == 0
    assert placed.select("doc_id", "shard").distinct().groupBy("doc_id").count().where("count > 1").count() == 0
    assert placement.place(no_docs, "doc_id", shards, 499).count() == 0
    with pytest.raises(ValueError):
        placement.place(edge_docs, "doc_id", shards.limit(0), 499)


def test_differences_keep_every_similar_pair():
    """Every similar pair of which a side is far from the centre shares a part with enough left behind it."""
    rng, c = random.Random(11), 0.2 / 1.8
    alike = 0
    for _ in range(300):
        centre = {h: rng.choice((1, 1, 1, 3)) for h in rng.sample(range(1, 10_000), 60)}
        far = dict(centre)
        for h in rng.sample(sorted(centre), 9):
            far.pop(h)
            far[h + 20_000] = rng.choice((1, 2))

        def near(base):
            out = dict(base)
            for h in rng.sample(sorted(base), rng.randrange(0, 5)):
                out[h] -= 1
                out[h + rng.randrange(30_000, 40_000)] = 1
            return {h: w for h, w in out.items() if w}

        def multiset(d):
            keys = np.array(sorted(d), dtype=np.uint64)
            return keys, np.array([d[int(k)] for k in keys], dtype=np.int64), sum(d.values())

        sets = [multiset(near(rng.choice((centre, far, far)))) for _ in range(6)]
        diffs = [near_duplicates.difference(s, multiset(centre), 0.8) for s in sets]
        for i, x in enumerate(sets):
            for j, y in enumerate(sets[:i]):
                if near_duplicates.overlap(x, y) < 0.8 or not (diffs[i][3] or diffs[j][3]):
                    continue
                alike += 1
                rest = [dict(zip(diffs[k][0].tolist(), diffs[k][1].tolist())) for k in (i, j)]
                need = diffs[i][2] + diffs[j][2] - c * (x[2] + y[2])
                assert any(2 * min(rest[0][g], rest[1][g]) >= need - 1e-6 for g in rest[0].keys() & rest[1].keys())
    assert alike > 300


def test_families_of_edited_copies(spark):
    """Many edited copies of one text and of a variant of it: classes as by brute force."""
    from test_queries import brute_classes

    rng = random.Random(3)
    base = [f"w{rng.randrange(5_000)}" for _ in range(150)]
    variant = base[:40] + [f"v{k}" for k in range(9)] + base[49:100] + base[95:]
    docs = {}
    for k in range(400):
        words = list(rng.choice((base, variant)))
        for _ in range(rng.randrange(0, 7)):
            at = rng.randrange(len(words))
            words[at:at + 1] = rng.choice(([f"n{rng.randrange(10**9)}"], [f"m{rng.randrange(4)}"], [], [words[at], words[at]]))
        docs[k] = " ".join(words)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.class_id for r in near_duplicates.class_table(df).collect()}
    expected = brute_classes(docs)
    assert found == expected and 10 < len(set(expected.values())) < 390
