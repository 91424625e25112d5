"""Languages against a naive Bayes in plain Python, and more languages than one matrix holds."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from churnlake.llm import language_id


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    alphabets = {f"l{k:03d}": rng.sample("abcdefghijklmnopqrstuvwxyzäöüßéèçñøåπλσ", 9) for k in range(23)}
    word = lambda letters: "".join(rng.choices(letters, k=rng.randrange(2, 8)))
    made = [(i, " ".join(word(letters) for _ in range(rng.randrange(3, 15))), lang)
            for i, (lang, letters) in enumerate(sorted(alphabets.items()) * 12)]
    return made + [(5000, None, "l001"), (5001, "12 34", None), (5002, "Äh, SO!", None), (None, "abc", None)]


def buckets(text):
    points = np.frombuffer((text.lower() + " ").encode("utf-32-le"), dtype=np.uint32)
    return Counter(b for ids, _ in language_id.bucket_ids(points, np.array([0])) for b in ids.tolist())


def brute(rows):
    counts, priors = defaultdict(Counter), Counter()
    for i, text, lang in rows:
        if lang and text is not None and zlib.crc32(str(i).encode()) % 5:
            priors[lang] += 1
            counts[lang] += buckets(text)
    out = {}
    for i, text, _ in rows:
        if text is None or not any(c.isalpha() for c in text):
            out[i] = ("und", 0.0)
            continue
        grams, size = buckets(text), 1 << language_id.BITS
        joint = {k: math.log(n / priors.total()) + sum(
            c * math.log((counts[k][b] + 1) / (counts[k].total() + size)) for b, c in grams.items()) for k, n in priors.items()}
        best = max(sorted(joint), key=joint.get)
        out[i] = (best, 1 / sum(math.exp(v - joint[best]) for v in joint.values()))
    return out


@pytest.mark.parametrize("at_once", [200, 5])
def test_as_by_hand(spark, rows, at_once):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in language_id.identify(df, at_once=at_once).collect()}
    expected = brute(rows)
    assert set(found) == set(expected)
    for i, (lang, score) in expected.items():
        assert found[i].lang_pred == lang and found[i].score == pytest.approx(score, abs=1e-4)
