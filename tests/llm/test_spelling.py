"""Spelling variants agree with a brute-force version."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from churnlake.llm import spelling
from churnlake.llm.queries import QUERIES


def brute_words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute_variants(counts, ratio=2):
    """Near words share a pattern: the word with one character taken out or wild."""
    patterns = defaultdict(set)
    for w in counts:
        for k in range(len(w)):
            patterns[w[:k] + "*" + w[k + 1:]].add(w)  # replacements
        for k in range(len(w) + 1):
            patterns[w[:k] + "*" + w[k:]].add(w)  # the shorter side of an insertion
    near = defaultdict(set)
    for group in patterns.values():
        for a in group:
            near[a] |= group - {a}
    # a pair of equal length that meets in an insertion pattern only cannot arise; lengths differ by one otherwise
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None)
    return out


def rows_of(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_query(spark, folder):
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    expected = brute_variants(brute_words(docs))
    found = rows_of(QUERIES["op12_spelling_variants"](spark, folder))
    assert len(expected) > 1000 and found == expected


COUNTS = {
    "house": 100, "hause": 3, "houses": 50, "hous": 9, "hhouse": 4, "houuse": 5, "mouse": 100, "aaaaa": 8, "aaaaaa": 20, "aaaa": 100,
    "éclat": 10, "èclat": 20, "eclat": 5, "zebra": 7, "zebre": 14, "zebrb": 14, "step": 3, "stepp": 6, "steppp": 12, "stepppp": 24,
    "x" * 70: 5, "x" * 69 + "y": 10, "x" * 71: 11, "y" * 64: 3, "y" * 63: 6, "ab" * 400: 3, "ab" * 399 + "a": 7,
}


@pytest.mark.parametrize("settings", [{}, {"bits": 1}, {"max_blocks": 1}])
def test_words(spark, settings):
    """Lengths around the shared filter, repeated letters, ties, chains; small filters give the same result."""
    words = spark.createDataFrame(list(COUNTS.items()), "word string, n long").withColumn("form", F.lit("clash"))
    found = rows_of(spelling.variants(words, **settings))
    assert found == brute_variants(COUNTS)
    assert found["steppp"][:2] == ("stepppp", "stepppp") and found["zebra"][0] == "zebrb" and found["x" * 70][0] == "x" * 71


def test_filters_hold_every_word(spark):
    counts = {f"word{i}": 3 for i in range(5000)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    filters = spelling.build_filters(words)
    for length, rows in spelling._by_length(list(counts)):
        names = [list(counts)[i] for i in rows]
        up, _ = spelling._power_table(length)
        hashes = spelling._terms(spelling._codes(names, length), up).sum(axis=1, dtype="uint64")
        assert len(filters.may_hold(length, hashes)) == len(names)
    assert len(filters.cells) * 8 <= 64 * (spelling.MAX_BLOCKS + spelling.LONG)


def test_edges(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        words = docs.select(F.explode(spelling.runs_of(F.col("text"))).alias("word"))
        held = spelling.vocabulary(words, 2, 1)
        expected = Counter(r.word for r in words.collect() if len(r.word) >= 2)
        assert rows_of(spelling.variants(held)) == brute_variants(dict(expected))
    assert spelling.variants(spark.createDataFrame([], "word string, n long")).collect() == []
