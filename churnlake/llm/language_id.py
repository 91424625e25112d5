"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, every run of characters that are not letters becomes one space, and all n-grams of one to three
characters are hashed into 65,536 buckets. Training sums bucket counts per language over a bounded sample of labelled
rows (``train_rows`` per language, expected number, chosen by a hash of the id); class priors come from all labelled
rows. The matrix of log-probabilities (languages x buckets) has a size set by parameters and is broadcast.

Scoring is a map over Arrow batches, no shuffle: a batch is cut into pieces of a bounded number of characters, the
n-grams of a piece are hashed in one go and each language's matrix row is gathered and summed per document. A text longer
than a piece is scored in several pieces whose sums are added, so that memory stays bounded and whole texts count.

Defined results: null texts and texts without a letter get ``und`` with score 0; without any labelled row every text
is ``und``; ties go to the first language by name; a null id hashes like the empty text; an empty table gives an empty
result. Any number of languages is learned: the matrix is made and broadcast for ``AT_ONCE`` of them at a time, and further
ones are scored in further passes that carry each text's best language so far. Other columns of the input are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import ship_package, staged

BITS = 16
ORDERS = (1, 2, 3)
PIECE = 400_000
TRAIN_ROWS = 4_000
#: Languages of one matrix: 52 MB in a worker.
AT_ONCE = 200
TRAIN_TASKS = 16
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_SPACE = 32


@functools.cache
def _letter_table() -> np.ndarray:
    """For each code point, whether it is a letter; built once per worker."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def pieces(texts: list[str], size: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Code points of whole texts or parts of long ones, with the index of each text and where it begins.

    Parts of one text overlap by the longest n-gram less one character, so no n-gram is lost; the few at a cut count twice.
    """
    keep, held, lap = [], 0, ORDERS[-1] - 1
    for row, text in enumerate(texts):
        at = 0
        while True:
            part = text[at:at + size]
            if held + len(part) > size and keep:
                yield _joined(keep)
                keep, held = [], 0
            keep.append((row, part))
            held += len(part)
            if at + size >= len(text):
                break
            at += size - lap
    if keep:
        yield _joined(keep)


def _joined(keep: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = np.array([r for r, _ in keep])
    text = "".join(p.lower() + " " for _, p in keep)  # every text ends with a space, wherever it stands in a batch
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum([len(p.lower()) + 1 for _, p in keep])
    return points, rows, np.concatenate([[0], ends[:-1]])


def bucket_ids(points: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the buckets of its n-grams and where each text's begin. N-grams across texts are left out."""
    letter = _letter_table()[np.minimum(points, 0x10FFFF)]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first space after a letter stays
    code = np.where(letter, points, _SPACE)[keep].astype(np.uint64)
    first = np.concatenate([[0], np.cumsum(keep)])[starts]
    owner = np.zeros(len(code) + 1, dtype=np.int32)
    np.add.at(owner, first, 1)
    owner = np.cumsum(owner)[:-1]
    mixed = np.zeros(len(code), dtype=np.uint64)
    for n in ORDERS:
        with np.errstate(over="ignore"):
            shifted = code[n - 1:] * np.uint64(MULTIPLIERS[n - 1])
            mixed = (mixed[:len(shifted)] ^ shifted) * np.uint64(MULTIPLIERS[0])
        one = owner[:len(shifted)] == owner[n - 1:]
        ids = (mixed[one] >> np.uint64(64 - BITS)).astype(np.int64)
        yield ids, owner[:len(shifted)][one] - 1


def _held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def train(labelled: DataFrame, sizes: dict[str, int], names: list[str], train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """Log-probabilities of ``names``, some of the languages whose labelled rows ``sizes`` counts.

    ``labelled`` has id, text, lang. The returned matrix has one row per language and 2**BITS + 1 columns, the last of
    which is the log prior.
    """
    if not names:
        return np.zeros((0, (1 << BITS) + 1), dtype=np.float32)
    share = F.create_map(*[F.lit(x) for k in names for x in (k, min(1.0, train_rows / sizes[k]))])
    luck = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("train")), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.where(luck < F.element_at(share, F.col("lang"))).select("lang", "text").repartition(TRAIN_TASKS)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(names), 1 << BITS), dtype=np.int64)
        code = {k: i for i, k in enumerate(names)}
        for batch in batches:
            langs = batch["lang"].map(code).to_numpy()
            for points, rows, starts in pieces(batch["text"].tolist()):
                for ids, owner in bucket_ids(points, starts):
                    flat = langs[rows[owner]] * (1 << BITS) + ids
                    total += np.bincount(flat, minlength=total.size).reshape(total.shape)
        lang, bucket = np.nonzero(total)
        yield pd.DataFrame({"lang": lang, "bucket": bucket, "n": total[lang, bucket]})

    summed = sample.mapInPandas(count, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = summed.toPandas()  # at most languages x buckets rows
    counts = np.ones((len(names), 1 << BITS))
    counts[found["lang"].to_numpy(int), found["bucket"].to_numpy(int)] += found["n"].to_numpy(float)
    table = np.log(counts / counts.sum(axis=1, keepdims=True))
    prior = np.log(np.array([sizes[k] for k in names], dtype=float) / sum(sizes.values()))
    return np.concatenate([table, prior[:, None]], axis=1).astype(np.float32)


def score_texts(texts: list[str], table: np.ndarray) -> np.ndarray:
    """Log joint of every text and language."""
    sums = np.repeat(table[:, -1][None, :].astype(np.float64), len(texts), axis=0)
    for points, rows, starts in pieces(texts):
        for ids, owner in bucket_ids(points, starts):
            for k in range(len(table)):
                part = np.bincount(owner, weights=table[k][ids], minlength=len(rows))
                np.add.at(sums[:, k], rows, part[:len(rows)])
    return sums


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             train_rows: int = TRAIN_ROWS, at_once: int = AT_ONCE) -> DataFrame:
    """id, held_out, lang_pred, score. Rows of the held-out fold and null languages are not learned from."""
    doc_id, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    labelled = docs.where(~_held_out(doc_id) & F.col(f"`{lang_col}`").isNotNull() & text.isNotNull()).select(
        doc_id.alias("id"), text.alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    ship_package(docs.sparkSession)
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # one row per language
    names = sorted(sizes)
    parts = [names[i:i + at_once] for i in range(0, len(names), at_once)] or [[]]
    readable = F.when(text.rlike(r"\p{L}"), text)
    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    scored = docs.select(doc_id.alias("id"), _held_out(doc_id).alias("held_out"), readable.alias("text"))
    for number, part in enumerate(parts):
        if number:
            scored = staged(scored, "languages")
        scored = _scored(scored, kind, part, train(labelled, sizes, part, train_rows), number > 0, part is parts[-1])
    return scored.select(F.col("id").alias(id_col), "held_out", "lang_pred", "score")


def _scored(texts: DataFrame, kind: str, names: list[str], table: np.ndarray, again: bool, last: bool) -> DataFrame:
    """``texts`` scored with the languages ``names``: best language, its log joint and the sum of all joints over that one;
    ``again`` if they carry these already. The last pass has the share of the best instead."""
    shared = texts.sparkSession.sparkContext.broadcast((names, table))

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        langs, matrix = shared.value
        for batch in batches:
            out = batch.copy() if again else batch.assign(lang_pred="und", best=-np.inf, total=0.0)
            rows = np.flatnonzero(batch["text"].notna().to_numpy())
            if len(rows) and langs:
                joint = score_texts(batch["text"].iloc[rows].tolist(), matrix)
                high, before = joint.max(axis=1), out["best"].to_numpy()[rows]
                top, found = np.maximum(high, before), out["lang_pred"].to_numpy(dtype=object)
                found[rows[high > before]] = np.array(langs, dtype=object)[joint.argmax(axis=1)[high > before]]
                sums = out[["best", "total"]].to_numpy(dtype=float)
                sums[rows, 1] = sums[rows, 1] * np.exp(before - top) + np.exp(joint - top[:, None]).sum(axis=1)
                sums[rows, 0] = top
                out["lang_pred"], out["best"], out["total"] = found, sums[:, 0], sums[:, 1]
            if last:
                out["score"] = np.divide(1.0, out["total"], out=np.zeros(len(out)), where=out["total"].to_numpy() > 0)
                out = out[["id", "held_out", "lang_pred", "score"]]
            yield out

    columns = "lang_pred string, score double" if last else "text string, lang_pred string, best double, total double"
    return texts.mapInPandas(predict, f"id {kind}, held_out boolean, {columns}")
