"""Near-duplicates by BagMinHash: weighted-Jaccard signatures, bands, verified multiset overlap.

**Signature.** A text is the multiset of its five-word shingles. For each shingle the weight axis is cut into the dyadic
intervals (0, 1], (1, 2], (2, 4], (4, 8], ..., each with its own Poisson process of points in time, whose rate is the
interval's length; a point also has a position of the signature and a level inside the interval. A shingle that occurs
w times owns the points at levels up to w, so that equal shingles of two texts share exactly the points of the smaller
weight. A position holds the time of its first point: two texts agree there with probability equal to their weighted
Jaccard similarity. All points before a time at which every position is very likely met are generated in vectorised
passes; texts with a position still empty are repeated with a later time, which leaves the signature exact.

**Candidates.** 28 bands of 5 positions: a pair of similarity 0.8 is missed with probability 1.5e-5. In each bucket the
members are compared with one representative only (a star) and links make components. After that only buckets of three
or more that still hold different components matter. For their texts it is counted how many of their shingles occur in
none of the others: those cannot be common to a pair, which bounds the similarity of every pair from above. Stars go
on for ``ROUNDS``, the first of them around the member with the smallest share of such shingles, the centre of a group of
edited copies. What is then still apart is found through the centre, without comparing all with all.

**Differences from the centre.** Let d(x) be the signed difference of the multisets of x and of the centre p of a bucket,
|d(x)| its absolute sum, n the sizes and c = (1 - s) / (1 + s). A pair is similar enough if and only if |d(x) - d(y)| <=
c (n(x) + n(y)), so the two differences must share at least (|d(x)| + |d(y)| - c (n(x) + n(y))) / 2. Where that is not
positive both texts are near to p: these links are made in the same step. All other pairs have a common part, and the first
one in a fixed order (gained before lost shingles) leaves at least that much behind it in both texts. So an equality join
on (p, part) that looks at what is left behind finds every such pair; parts too far back for any partner are not written.

**Verification.** Both texts are joined to the candidate pairs and the overlap of the multisets is counted. Texts leave
the scan only for pairs. Classes are the connected components of the verified links between texts; equal texts
(same MD5) are one text, so copies never meet in pairs.

Keys are combined before every shuffle that groups; joins on hot buckets or representatives are equality joins that
adaptive execution splits. Nothing but counts reaches the driver.

Defined results: a null text is a class of its own; equal texts are one class, also if empty or without a word; texts
of one to four words have one shingle, all their words; ties go to the smallest id, null ids last; of rows with
equal id and text one stays; extra columns are carried; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm.common import SHINGLE, SIMILARITY, as_row, ship_package, staged
from churnlake.llm.components import components
from churnlake.llm.textbytes import chunks, mix, shingle_counts

BANDS, ROWS = 28, 5
ROUNDS = 3
BATCH = 1_000


def signatures(owner: np.ndarray, hashes: np.ndarray, counts: np.ndarray, texts: int, size: int) -> np.ndarray:
    """BagMinHash signatures (texts x size) of sorted multisets; rows of texts without shingles are infinite."""
    out = np.full((texts, size), np.inf)
    weight = np.bincount(owner, weights=counts, minlength=texts)
    todo, slack = np.flatnonzero(weight > 0), 3.0
    while len(todo):
        until = np.zeros(texts)
        until[todo] = size * (np.log(size) + slack) / weight[todo]
        out[todo] = np.inf
        chosen = until[owner] > 0
        _points(owner[chosen], hashes[chosen], counts[chosen], until, out)
        todo = todo[np.isinf(out[todo]).any(axis=1)]
        slack += 5
    return out


def _multiple(n: int, odd: int) -> np.uint64:
    return np.uint64(n * odd & (1 << 64) - 1)


def _points(owner, hashes, counts, until, out) -> None:
    """Put the earliest time of every position before ``until`` into ``out``."""
    size, flat = out.shape[1], out.reshape(-1)
    level, lower = 0, 0
    while len(owner):
        length = max(1, lower)
        seed = mix(hashes + _multiple(level + 1, 0xA24BAED4963EE407))
        who, room, time, step = owner, counts - lower, np.zeros(len(owner)), 0
        while len(who):
            step += 1
            draw = mix(seed + _multiple(step, 0x9FB21C651E98DF25))
            time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / length
            inside = time <= until[who]
            who, seed, room, time, draw = who[inside], seed[inside], room[inside], time[inside], draw[inside]
            place = mix(draw ^ np.uint64(0xD1B54A32D192ED03))
            position = ((place >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
            # The low bits halve the interval again and again: the level, counted from its lower end.
            owned = (place & np.uint64(length - 1)).astype(np.int64) < room
            np.minimum.at(flat, (who * size + position)[owned], time[owned])
        lower = max(1, lower * 2)
        level += 1
        more = counts > lower
        owner, hashes, counts = owner[more], hashes[more], counts[more]


def band_codes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit code for every text and band, different between bands."""
    bits = signature.view(np.uint64).reshape(len(signature), bands, rows)
    odd = mix(np.arange(3, 3 + rows, dtype=np.uint64)) | np.uint64(1)
    return mix((mix(bits) * odd).sum(axis=2, dtype=np.uint64) + mix(np.arange(1, bands + 1, dtype=np.uint64))).view(np.int64)


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH):
    """Fewer rows in an Arrow batch while texts, of any length, go to Python."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_signatures(docs: DataFrame, text: Column, bands: int, rows: int) -> DataFrame:
    """key, n (shingles) and band codes, one row for each distinct text that has a word."""
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = batch["key"].to_numpy()
            for at, data in chunks(batch["text"].tolist()):
                owner, hashes, counts = shingle_counts(data, SHINGLE)
                codes = band_codes(signatures(owner, hashes, counts, len(data), bands * rows), bands, rows)
                total = np.bincount(owner, weights=counts, minlength=len(data)).astype(np.int64)
                some = np.flatnonzero(total)
                yield pd.DataFrame({"key": keys[np.array(at)[some]], "n": total[some], "codes": pd.Series(list(codes[some]), dtype=object)})

    ready = docs.where(text.isNotNull()).select(F.md5(text).alias("key"), text.alias("text"))
    signed = ready.mapInPandas(sign, "key string, n long, codes array<long>")
    with small_batches(docs.sparkSession, 4 * BATCH):
        return staged(signed.groupBy("key").agg(F.first("n").alias("n"), F.first("codes").alias("codes")), "signatures")


def with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` (a, b and other columns) with text_a and text_b. ``texts`` has key, text."""
    left = texts.select(F.col("key").alias("ka"), F.col("text").alias("text_a"))
    right = texts.select(F.col("key").alias("kb"), F.col("text").alias("text_b"))
    return pairs.join(left, F.col("a") == F.col("ka")).join(right, F.col("b") == F.col("kb")).drop("ka", "kb")


def multisets(batch: pd.DataFrame) -> dict[str, tuple]:
    """Sorted multiset (hashes, counts, total) of every text of a batch of ``with_texts``, by key."""
    both = dict(zip(batch["a"], batch["text_a"])) | dict(zip(batch["b"], batch["text_b"]))
    keys = list(both)
    sets = {}
    for at, data in chunks([both[k] for k in keys]):
        owner, hashes, counts = shingle_counts(data, SHINGLE)
        order = np.lexsort((hashes, owner))
        owner, hashes, counts = owner[order], hashes[order], counts[order]
        edges = np.searchsorted(owner, np.arange(len(data) + 1))
        for k, x, y in zip(at, edges[:-1], edges[1:]):
            sets[keys[k]] = (hashes[x:y], counts[x:y], int(counts[x:y].sum()))
    return sets


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose multisets are similar enough, written."""
    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = multisets(batch)
            keep = [overlap(sets[a], sets[b]) >= similarity for a, b in zip(batch["a"], batch["b"])]
            yield batch.loc[np.array(keep, dtype=bool), ["a", "b"]]

    joined = with_texts(pairs, texts).select("a", "b", "text_a", "text_b")
    with small_batches(pairs.sparkSession):
        return staged(joined.mapInPandas(check, "a string, b string"), "near-links")


def difference(x: tuple, centre: tuple, similarity: float) -> tuple[np.ndarray, np.ndarray, int, bool]:
    """Of a multiset and the centre: the parts of the signed difference that a partner can begin with, the weight from
    each part to the end, the whole weight, and whether the two are too far apart for a link."""
    hashes, at = np.unique(np.concatenate([x[0], centre[0]]), return_inverse=True)
    signed = np.bincount(at, weights=np.concatenate([x[1], -centre[1]]), minlength=len(hashes)).astype(np.int64)
    some = signed != 0
    hashes, signed = hashes[some], signed[some]
    order = np.lexsort((hashes, signed < 0))
    hashes, signed = hashes[order], signed[order]
    weight = np.abs(signed)
    total = int(weight.sum())
    rest = total - np.cumsum(weight) + weight
    ratio = (1 - similarity) / (1 + similarity)
    beyond = total - ratio * (x[2] + centre[2])
    far = beyond > -1e-6
    # The least common weight with any partner, for which at least one of the two is far from the centre.
    least = max(1.0, beyond / (1 + ratio)) if far else max(1.0, (1 - ratio) * total / 2)
    use = rest >= least - 1e-6
    parts = np.where(signed < 0, mix(hashes ^ np.uint64(0x9FB21C651E98DF25)), hashes)
    return parts[use].view(np.int64), rest[use], total, bool(far)


def across(named: DataFrame, live: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of members of live buckets, of different components, whose differences from the centre can be close,
    and members with a centre they are near to: after their links, two texts near to one centre are in one component."""
    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = multisets(batch)
            for a, b, comp, apart in zip(batch["a"], batch["b"], batch["comp"], batch["apart"]):
                begin, rest, total, far = difference(sets[b], sets[a], similarity)
                if not far and not len(begin):  # a row that tells that it is near
                    begin, rest = np.zeros(1, np.int64), np.zeros(1, np.int64)
                yield pd.DataFrame({"a": a, "part": begin, "b": b, "comp": comp, "n": sets[b][2], "rest": rest, "total": total,
                                    "far": far, "apart": apart})

    # The centre of a bucket hands over to the most central text among the centres of its own buckets, and that one again,
    # so that the buckets of a family meet around few texts. A centre need not be a member.
    open_ = live.where("m > 2").select(F.col("bucket").alias("of"), F.struct(F.col("rep.o").alias("o"), F.col("rep.key").alias("key")).alias("to"))
    heads = open_.select(F.col("to.key").alias("head")).distinct()
    above = staged(
        named.join(open_, F.col("bucket") == F.col("of")).join(heads, F.col("key") == F.col("head"), "left_semi")
        .groupBy("key").agg(F.min("to").alias("to")).select("key", F.col("to.key").alias("up")), "near-above")
    up = lambda k: above.select(F.col("key").alias(f"k{k}"), F.col("up").alias(f"up{k}"))
    centres = (
        open_.select("of", F.col("to.key").alias("q")).join(up(1), F.col("q") == F.col("k1")).join(up(2), F.col("up1") == F.col("k2"))
        .select("of", F.col("up2").alias("a")))
    comps = named.select(F.col("key").alias("ka"), F.col("comp").alias("comp_a")).distinct()
    spokes = staged(
        named.join(centres, F.col("bucket") == F.col("of")).where(F.col("key") != F.col("a"))
        .select("a", F.col("key").alias("b"), "comp").distinct().join(comps, F.col("a") == F.col("ka"))
        .select("a", "b", "comp", (F.col("comp") != F.col("comp_a")).alias("apart")), "near-spokes")
    with small_batches(named.sparkSession):
        entries = staged(
            with_texts(spokes, texts).select("a", "b", "comp", "apart", "text_a", "text_b").mapInPandas(
                parts, "a string, part long, b string, comp string, n long, rest long, total long, far boolean, apart boolean"),
            "near-parts")
    x, y = entries.where("far").alias("x"), entries.alias("y")
    ratio = F.lit((1 - similarity) / (1 + similarity))
    need = F.col("x.total") + F.col("y.total") - ratio * (F.col("x.n") + F.col("y.n"))
    met = x.join(y, (F.col("x.a") == F.col("y.a")) & (F.col("x.part") == F.col("y.part")) & (F.col("x.comp") != F.col("y.comp"))
                 & (~F.col("y.far") | (F.col("x.b") < F.col("y.b")))
                 & (2 * F.least("x.rest", "y.rest") >= need - F.lit(1e-6)))
    near = entries.where("apart AND NOT far").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return met.select(F.least("x.b", "y.b").alias("a"), F.greatest("x.b", "y.b").alias("b")).unionByName(near).distinct()


def overlap(x: tuple, y: tuple) -> float:
    """Weighted Jaccard similarity of two sorted multisets (hashes, counts, total)."""
    if len(x[0]) > len(y[0]):
        x, y = y, x
    if not len(x[0]):
        return 0.0
    at = np.minimum(np.searchsorted(y[0], x[0]), len(y[0]) - 1)
    same = y[0][at] == x[0]
    common = int(np.minimum(x[1][same], y[1][at[same]]).sum())
    return common / (x[2] + y[2] - common)


def text_classes(docs: DataFrame, text: Column, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS,
                 rounds: int = ROUNDS) -> DataFrame:
    """key, comp: MD5 of every text that is linked to another text, and the smallest MD5 of its class."""
    spark = docs.sparkSession
    signed = text_signatures(docs, text, bands, rows)
    entries = signed.select("key", "n", F.explode("codes").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select(F.col("bucket").alias("of"))
    members = staged(entries.join(shared, F.col("bucket") == F.col("of"), "left_semi"), "near-members")
    keys = members.select(F.col("key").alias("of")).distinct()
    texts = staged(
        docs.where(text.isNotNull()).groupBy(F.md5(text).alias("key")).agg(F.first(text).alias("text"))  # copies combine before they move
        .join(keys, F.col("key") == F.col("of"), "left_semi"), "near-texts")
    members = members.withColumn("loose", F.lit(0).cast("long"))
    labels = spark.createDataFrame([], "key string, comp string")
    tried = spark.createDataFrame([], "a string, b string")
    most = F.least(F.col("n") - F.col("loose"), F.col("rep_n") - F.col("rep_loose"))
    fits = most >= F.lit(similarity) * (F.col("n") + F.col("rep_n") - most) - F.lit(1e-9)

    for turn in range(rounds + 1):
        named = members.join(labels.select(F.col("key").alias("of"), "comp"), F.col("key") == F.col("of"), "left").select(
            "bucket", "key", "n", "loose", F.coalesce("comp", "key").alias("comp"))
        named = staged(named, "near-named")
        central = turn in (1, rounds)
        order = F.floor(F.col("loose") * 1000 / F.col("n")) if central else F.xxhash64("key", F.lit(turn))
        live = staged(named.groupBy("bucket").agg(
            F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("m"),
            F.min(F.struct(order.alias("o"), "key", "n", "loose", "comp")).alias("rep")).where("low < high"), "near-live")
        if not live.limit(1).count():
            break
        if turn < rounds:
            stars = live.select(
                F.col("bucket").alias("of"), F.col("rep.key").alias("rep_key"), F.col("rep.n").alias("rep_n"),
                F.col("rep.loose").alias("rep_loose"), F.col("rep.comp").alias("rep_comp"))
            met = named.join(stars, F.col("bucket") == F.col("of")).where((F.col("comp") != F.col("rep_comp")) & fits)
            pairs = met.select(F.least("key", "rep_key").alias("a"), F.greatest("key", "rep_key").alias("b")).distinct()
        else:
            pairs = across(named, live, texts, similarity)
        known = tried.select(F.col("a").alias("ta"), F.col("b").alias("tb"))
        pairs = staged(pairs.join(known, (F.col("a") == F.col("ta")) & (F.col("b") == F.col("tb")), "left_anti"), "near-pairs")
        if pairs.limit(1).count():
            links = verified(pairs, texts, similarity)
            tried = staged(tried.unionByName(pairs), "near-tried")
            if links.limit(1).count():
                labels = _merged(labels, links)
        if turn == 0:
            members = _linkable(members, live, texts, similarity)
    return labels


def _linkable(members: DataFrame, live: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Members of live buckets of three or more (the star has settled those of two), with ``loose``: how many of their
    shingles occur in no other such text. None of these can be common to a pair, so a member with too many is out."""
    open_ = live.where("m > 2").select(F.col("bucket").alias("l"))
    left = staged(members.drop("loose").join(open_, F.col("bucket") == F.col("l"), "left_semi"), "near-open")
    keys = left.select(F.col("key").alias("of")).distinct()

    def shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch["id"].to_numpy()
            for at, data in chunks(batch["text"].tolist()):
                owner, hashes, counts = shingle_counts(data, SHINGLE)
                yield pd.DataFrame({"id": ids[np.array(at)[owner]], "hash": hashes.view(np.int64), "c": counts})

    chosen = texts.join(keys, F.col("key") == F.col("of"), "left_semi").select(F.xxhash64("key").alias("id"), "text")
    once = (
        chosen.mapInPandas(shingles, "id long, hash long, c long")
        .groupBy("hash").agg(F.count(F.lit(1)).alias("texts"), F.min("id").alias("id"), F.min("c").alias("c"))
        .where("texts = 1").groupBy("id").agg(F.sum("c").alias("loose")))
    with small_batches(members.sparkSession):
        once = staged(once.select(F.col("id").alias("i"), "loose"), "near-loose")
    counted = left.join(once, F.xxhash64("key") == F.col("i"), "left").select(
        "bucket", "key", "n", F.coalesce("loose", F.lit(0)).cast("long").alias("loose"))
    return staged(counted.where(F.col("loose") <= F.lit(1 - similarity) * F.col("n") + F.lit(1e-9)), "near-members")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links: components of the links between labels, carried over to the keys."""
    label = lambda side: labels.select(F.col("key").alias(f"k{side}"), F.col("comp").alias(f"c{side}"))
    between = (
        links.join(label("a"), F.col("a") == F.col("ka"), "left").join(label("b"), F.col("b") == F.col("kb"), "left")
        .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    merged = components(between)
    old = labels.join(merged.select(F.col("key").alias("was"), F.col("comp").alias("now")), F.col("comp") == F.col("was"), "left")
    old = old.select("key", F.coalesce("now", "comp").alias("comp"))
    return staged(old.unionByName(merged).groupBy("key").agg(F.min("comp").alias("comp")), "near-labels")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> tuple[DataFrame, DataFrame]:
    """Text keys with their class (key, comp), and classes (comp, class_id, rep_key, n_docs, repeated)."""
    ship_package(docs.sparkSession)
    text = F.col(f"`{text_col}`")
    labels = text_classes(docs, text, **settings)
    rows = docs.where(text.isNotNull()).groupBy(F.md5(text).alias("key"), F.col(f"`{id_col}`").alias("id")).agg(
        F.count(F.lit(1)).alias("rows"))
    least = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "key", "rows"))
    by_key = rows.groupBy("key").agg(least.alias("first"), F.sum("rows").alias("n"))
    named = staged(by_key.join(labels.select(F.col("key").alias("of"), "comp"), F.col("key") == F.col("of"), "left").select(
        "key", F.coalesce("comp", "key").alias("comp"), "first", "n"), "near-texts-named")
    summary = named.groupBy("comp").agg(F.min("first").alias("first"), F.sum("n").alias("n_docs")).select(
        "comp", F.col("first.id").alias("class_id"), F.col("first.key").alias("rep_key"), "n_docs",
        (F.col("first.rows") > 1).alias("repeated"))
    return named.select("key", "comp"), staged(summary, "near-classes")


def class_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """id, class_id (the smallest id of the class), n_docs (documents of the class), one row per document."""
    keys, summary = classes(docs, id_col, text_col, **settings)
    of_key = keys.join(summary.select(F.col("comp").alias("c"), "class_id", "n_docs"), F.col("comp") == F.col("c")).select(
        F.col("key").alias("of"), "class_id", "n_docs")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.md5(F.col(f"`{text_col}`")).alias("key"))
    joined = rows.join(of_key, F.col("key") == F.col("of"), "left")
    return joined.select(
        F.col("id").alias(id_col), F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_docs", F.lit(1)).cast("long").alias("n_docs"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The documents with one of each class left: that of the smallest id."""
    _, summary = classes(docs, id_col, text_col, **settings)
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.md5(text).alias("key"), F.col(f"`{id_col}`").alias("id"), as_row(docs).alias("row"))
    kept = rows.join(summary, (F.col("key") == F.col("rep_key")) & F.col("id").eqNullSafe(F.col("class_id")), "inner")
    single = kept.where(~F.col("repeated")).select("row")
    repeated = kept.where("repeated").groupBy("rep_key").agg(F.first("row").alias("row")).select("row")
    untold = rows.where(F.col("key").isNull()).select("row")
    return single.unionByName(repeated).unionByName(untold).select("row.*")
