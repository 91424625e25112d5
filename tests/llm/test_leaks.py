"""Decontamination against brute force: all windows, weighted shingles, no Hamming filter."""

import random
from collections import Counter

import pytest

from churnlake.llm import decontamination


def shingles(words):
    return Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def similar(a, b):
    common = sum((a & b).values())
    return 100 * common >= 80 * (sum(a.values()) + sum(b.values()) - common)


def brute(docs, items):
    found, cut = set(), [(i, len(item.split()), shingles(item.split())) for i, item in items]
    for d, text in docs:
        words = text.split()
        here = shingles(words)
        for i, n, wanted in cut:
            if not wanted & here:
                continue
            for s in range(5 - n, len(words) - 4):
                if similar(shingles(words[max(0, s):s + n]), wanted):
                    found.add((d, i))
                    break
    return found


def word(rng):
    return f"w{rng.randrange(10**9)}"


@pytest.fixture(scope="module")
def leaks(spark):
    """Which kinds of passages brute force finds, and which the operator finds."""
    rng, docs, items = random.Random(3), [], []
    around = lambda n: [word(rng) for _ in range(n)]
    for n in (16, 23, 40, 60, 100):
        for k in range(12):
            item = around(n)
            items.append((n * 100 + k, " ".join(item)))
            edge = max(1, (n - 4) // 9)
            one = list(item)
            one[rng.randrange(n)] = word(rng)
            half, left = n // 2, n - max(1, (n - 4) // 5)
            kinds = {"edge": around(9) + around(edge) + item[edge:] + around(9), "word": around(3) + one + around(30),
                     "moved": around(20) + item[half:] + item[:half] + around(20), "end": around(30) + item[:left],
                     "begin": item[n - left:] + around(30), "short": item[:left], "none": around(80)}
            docs += [(f"{kind}-{n}-{k}", " ".join(text)) for kind, text in kinds.items()]
    found = decontamination.contaminated(
        spark.createDataFrame(docs, "doc_id string, text string"), spark.createDataFrame(items, "item_id long, text string"))
    return brute(docs, items), {(r.doc_id, r.item_id) for r in found.collect()}


@pytest.mark.parametrize("kind", ["edge", "word", "moved", "end", "begin", "short", "none"])
def test_every_similar_window_is_found(leaks, kind):
    expected, found = [{p for p in pairs if p[0].startswith(kind)} for pairs in leaks]
    assert found == expected and bool(expected) == (kind != "none")
