"""Queries with SQL agree with it; the others with a brute-force version over the whole small table."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import connect, difference

import __spark_entry__ as contract
from churnlake.llm.oracles import ORACLES
from churnlake.llm.queries import QUERIES, tokenizer_file


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, folder, name):
    assert difference(QUERIES[name](spark, folder), connect(folder), ORACLES[name]) is None


def test_registered():
    assert set(QUERIES) <= set(contract.queries()) and "pipeline" in contract.queries()
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def texts(spark, folder):
    return {r[0]: r[1] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}


def test_token_blocks(spark, folder):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file())
    expected, start = [], 0
    for doc_id, text in sorted(texts(spark, folder).items()):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = QUERIES["op4_token_blocks"](spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, found.collect())) == expected


def test_language_held_out_accuracy(spark, folder):
    truth = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("doc_id", "lang", "crc32(string(doc_id)) % 5 = 0 AS h")
    rows = QUERIES["op2_language_id"](spark, folder).join(truth, "doc_id").collect()
    assert all(r.held_out == r.h and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == r.lang for r in rows if r.held_out]
    assert sum(held) >= 0.97 * len(held)


def shingles(text):
    words = (text or "").split()
    return Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4)) if len(words) > 4 else Counter([tuple(words)] if words else [])


def brute_classes(docs):
    sets, holders, parent = {k: shingles(t) for k, t in docs.items()}, defaultdict(list), {k: k for k in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, s in sets.items():
        for g in s:
            holders[g].append(k)
    for a, b in {(m[i], y) for m in holders.values() for i in range(len(m)) for y in m[i + 1:]}:
        common = sum((sets[a] & sets[b]).values())
        if common >= 0.8 * (sum(sets[a].values()) + sum(sets[b].values()) - common):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in docs}


def test_near_duplicates(spark, folder):
    found = {r.doc_id: r.class_id for r in QUERIES["op6_near_duplicates"](spark, folder).collect()}
    assert found == brute_classes(texts(spark, folder))


def brute_removed(docs):
    seen = Counter()
    for text in docs.values():
        data = (text or "").encode()
        seen.update(data[a:a + 200] for a in range(len(data) - 199))
    for doc_id, text in docs.items():
        data = (text or "").encode()
        change = np.zeros(len(data) + 201, int)
        for a in range(len(data) - 199):
            if seen[data[a:a + 200]] > 1:
                change[a] += 1
                change[a + 200] -= 1
        gone = np.cumsum(change)[:len(data)] > 0
        left = np.frombuffer(data, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        yield doc_id, len(data), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()


def test_suffix_dedup(spark, folder):
    found = QUERIES["op8_suffix_dedup"](spark, folder)
    assert sorted(map(tuple, found.collect())) == sorted(brute_removed(texts(spark, folder)))


def test_suffix_dedup_over_shards(spark, folder):
    from churnlake.llm import suffix_dedup

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = suffix_dedup.removed(docs, shard_bytes=50_000, split_units=1)  # every shared anchor is split
    assert sorted(map(tuple, found.collect())) == sorted(brute_removed(texts(spark, folder)))


def test_pipeline(spark, folder):
    """Each stage against its brute-force version: exact verdicts, classes, leaks; targets and tokens from its rows."""
    import corpus_pipeline
    from churnlake.llm import decontamination, mixing, quality_rules

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("labels", "benchmark"))
    good = {r.id for r in quality_rules.judge(docs, labels).where("kept").collect()}
    first = corpus_pipeline.keep_quality(spark, docs, folder)
    assert {r.doc_id for r in first.collect()} == good and first.columns == docs.columns
    one = corpus_pipeline.keep_one_copy(spark, first, folder)
    kept = {k: t for k, t in texts(spark, folder).items() if k in good}
    assert sorted(r.doc_id for r in one.collect()) == sorted(set(brute_classes(kept).values())) and one.columns == docs.columns
    clean = corpus_pipeline.keep_clean(spark, one, folder)
    leaks = {r.doc_id for r in decontamination.contaminated(one, items).collect()}
    passages = [r.text for r in items.collect()]
    rows = clean.collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in one.collect()} - leaks
    assert not any(p in r.text for r in rows for p in passages) and clean.columns == docs.columns
    mixed = corpus_pipeline.mix_sources(spark, clean, folder)
    expected = {r.doc_id: r.copies for r in mixing.mix(clean, boundary="whole").collect() if r.copies}
    assert Counter(r.doc_id for r in mixed.collect()) == expected and mixed.columns == docs.columns
    assert corpus_pipeline.run(spark, folder).count() == sum(expected.values())
