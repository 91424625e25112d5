"""Removal of repeated byte strings by suffix arrays.

A byte goes if a string of 200 bytes that covers it also starts anywhere else. The strings ("windows") are judged on the
input. Full suffix arrays are built only for the bytes for which hashes leave the question open:

1. Every window has a 64-byte anchor: of the 137 runs of 64 bytes in it, the one with the smallest hash, the first on ties.
   Equal windows have equal anchors at equal places. Successive windows with the same anchor form a unit, on average
   about 270 bytes, and a map over the texts emits for each unit a hash of its anchor and one of its bytes.
2. A unit whose anchor occurs once holds no repeated window. A unit that occurs twice is repeated as a whole. What
   is left are units that share their anchor only with different units: the edges of repeated passages.
3. Those, and one example of each unit with the same anchor, are cut out of the texts and sent to shards by anchor.
   A shard sorts the suffixes of its bytes by Larsson-Sadakane refinement (prefix doubling that sorts unfinished groups only),
   takes common prefixes of neighbours by Kasai's pass, run in many lanes at once, and marks the windows whose
   common prefix with a neighbour reaches 200.
4. An anchor with very many different units is split over several shards. Their windows are then merged by binary
   search: windows are dealt out by hash, and each shard's sorted windows are looked up in those of the others.
5. The repeated windows of each text are joined to it, merged to spans and cut out.

Texts are addressed by two hashes of theirs (96 bits), so copies are one text here and a repeated unit is counted once
for each copy. Groups are combined before the shuffle; memory of a task is set by the chunk and shard sizes.

Defined results: a null text is empty; texts shorter than a window lose nothing; repeated rows are copies of each other;
texts of any length are cut into pieces that overlap by a window less one byte; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from churnlake.llm.common import ship_package, staged
from churnlake.llm.near_duplicates import small_batches
from churnlake.llm.textbytes import chunks, mix, run_hashes

WINDOW, ANCHOR = 200, 64
RUNS = WINDOW - ANCHOR + 1
PIECE = 4_000_000
SHARD_BYTES = 3_000_000
SPLIT_UNITS = 4_000
LANES = 4_096
_LOW = np.uint64((1 << 24) - 1)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` successive values, by running minima from both ends of blocks."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def units(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """text number, first window, windows less one, place of the anchor, anchor hash, unit hash of every unit."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    if len(data) < WINDOW:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    ends = np.cumsum(sizes)
    at = np.arange(len(data) - ANCHOR + 1)
    hashes = run_hashes(data, at, at + ANCHOR)
    least = _sliding_least((hashes & ~_LOW) | at.astype(np.uint64), RUNS)
    owner = np.repeat(np.arange(len(texts)), sizes)[:len(least)]
    valid = at[:len(least)] + WINDOW <= ends[owner]
    anchor = (least & _LOW).astype(np.int64)
    same = np.zeros(len(least), dtype=bool)
    same[1:] = (anchor[1:] == anchor[:-1]) & (owner[1:] == owner[:-1]) & valid[:-1]
    first = np.flatnonzero(valid & ~same)
    ordinal = np.cumsum(valid & ~same)[valid] - 1
    count = np.bincount(ordinal, minlength=len(first))
    place = anchor[first]
    whole = run_hashes(data, first, first + count - 1 + WINDOW)
    whole = mix(whole ^ (place - first + 1).astype(np.uint64))
    who = owner[first]
    return who, first - (ends - sizes)[who], count - 1, place - first, hashes[place], whole


def pieces(texts: list[str]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Row numbers, byte offsets and bytes: whole texts, long ones in pieces that overlap by a window less one byte."""
    for rows, data in chunks(texts):
        if len(data) == 1 and len(data[0]) > PIECE:
            for a in range(0, max(1, len(data[0]) - WINDOW + 1), PIECE):
                yield rows, [a], [data[0][a:a + PIECE + WINDOW - 1]]
        else:
            yield rows, [0] * len(rows), data


def suffix_order(data: np.ndarray) -> np.ndarray:
    """The suffix array: positions in the order of the bytes from there to the end.

    Larsson-Sadakane: groups are numbered by their first place; each pass sorts, inside the groups that still have
    more than one member, by the group of the position ``known`` bytes further on, which doubles what is known. Of
    suffixes that end before it the shorter goes first, as zeros at the end look like what follows the end.
    """
    n = len(data)
    group, known = (_words8(data), 8) if data.dtype == np.uint8 else (data, 1)
    order = np.argsort(group).astype(np.int32)
    rank = np.empty(n, dtype=np.int32)
    group = group[order]
    new = np.concatenate([[True], group[1:] != group[:-1]])
    del group
    rank[order] = _first_places(new, np.arange(n, dtype=np.int32))
    while True:
        sizes = np.bincount(rank, minlength=n)
        open_places = np.flatnonzero(sizes[rank[order]] > 1).astype(np.int32)
        del sizes
        if not len(open_places):
            return order
        members = order[open_places]
        further = members + np.int32(known)
        further = np.where(further < n, rank[np.minimum(further, n - 1)], n - further - 1).astype(np.int64)
        # one number for both: what follows lies between -2n and n
        inner = np.argsort(rank[members] * np.int64(4 * n) + (further + 2 * n))
        members, further = members[inner], further[inner]
        del inner
        order[open_places] = members
        before = rank[members]
        new = np.concatenate([[True], (before[1:] != before[:-1]) | (further[1:] != further[:-1])])
        del further, before
        rank[members] = _first_places(new, open_places)
        known *= 2


def _first_places(new: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For each member the place of the first of its group; ``new`` marks the firsts."""
    return np.maximum.accumulate(np.where(new, places, np.int32(0)))


def _words8(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as one number that compares like them; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.zeros(len(data), dtype=np.uint64)
    for k in range(8):
        out <<= np.uint64(8)
        out |= padded[k:k + len(data)]
    return out


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For every place of the order, the length of the common prefix with the place before, up to ``depth``.

    Kasai: going through the text, the common prefix is at least that of the position before, less one. Many lanes, each
    a stretch of the text, take a step together; a comparison is of eight bytes or of one number.
    """
    n = len(data)
    wide = 8 if data.dtype == np.uint8 else 1  # symbols in a comparison
    words = np.concatenate([_words8(data) if wide == 8 else data.astype(np.uint64), np.zeros(depth + 8, np.uint64)])
    place = np.empty(n, dtype=np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    out = np.zeros(n, dtype=np.int32)
    stretch = -(-n // LANES)
    lanes = np.arange(0, n, stretch)
    have = np.zeros(len(lanes), dtype=np.int64)
    for step in range(stretch):
        i = lanes + step
        use = i < n
        i, h = i[use], np.maximum(have[use] - 1, 0)
        p = place[i]
        j = np.where(p > 0, order[np.maximum(p - 1, 0)], n).astype(np.int64)
        h[p == 0] = 0
        run = np.flatnonzero(p > 0)
        while len(run):
            a, b = i[run] + h[run], j[run] + h[run]
            apart = words[a] ^ words[b]
            if wide == 8:  # bytes above the highest bit that differs; without the bit below it no rounding passes it
                equal = 8 - (np.frexp((apart & ~(apart >> np.uint64(1))).astype(np.float64))[1].astype(np.int64) + 7) // 8
            else:
                equal = (apart == 0).astype(np.int64)
            room = np.minimum(n - np.maximum(a, b), depth - h[run])
            h[run] += np.minimum(equal, room)
            run = run[(equal == wide) & (room > wide)]
        out[p] = h
        have[use] = h
    return out


def repeated_windows(parts: list[bytes], counts: np.ndarray) -> list[np.ndarray]:
    """For each part, which of its first ``counts`` windows also start somewhere else in the parts."""
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    begin = np.cumsum(sizes) - sizes
    window = np.zeros(len(data), dtype=bool)
    for b, c in zip(begin, counts):
        window[b:b + c] = True
    order = suffix_order(data)
    long = common_prefixes(data, order, WINDOW) >= WINDOW
    # Neighbours that are no windows (they reach over a part's end) may stand between two equal windows.
    group = np.cumsum(~long) - 1
    windows = window[order]
    members = np.bincount(group[windows], minlength=group[-1] + 1 if len(group) else 0)
    marked = np.zeros(len(data), dtype=bool)
    marked[order[windows & (members[group] > 1)]] = True
    return [marked[b:b + c] for b, c in zip(begin, counts)]


def _key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.crc32(text).alias("k2")]


_UNIT = "k1 long, k2 long, spot long, g long, u long"


def unit_table(docs: DataFrame, text: Column) -> DataFrame:
    """k1, k2 (text), spot (first window, windows less one, anchor place), g (anchor hash), u (unit hash)."""
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            k1, k2 = batch["k1"].to_numpy(), batch["k2"].to_numpy()
            for rows, offsets, data in pieces(batch["text"].tolist()):
                who, lo, more, place, g, u = units(data)
                row = np.array(rows)[who]
                spot = (lo + np.array(offsets)[who]) << 16 | more << 8 | place
                yield pd.DataFrame({"k1": k1[row], "k2": k2[row], "spot": spot, "g": g.view(np.int64), "u": u.view(np.int64)})

    long = docs.where(F.octet_length(text) >= WINDOW).select(*_key(text), text.alias("text"))
    with small_batches(docs.sparkSession, 4_000):
        return staged(long.mapInPandas(emit, _UNIT), "suffix-units")


def spans(docs: DataFrame, text: Column, shard_bytes: int = SHARD_BYTES, split_units: int = SPLIT_UNITS) -> DataFrame:
    """k1, k2, begin, end: byte ranges that repeated windows cover, of every text that has one."""
    found = unit_table(docs, text)
    multi = found.groupBy("g").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select(F.col("g").alias("of"))
    shared = staged(found.join(multi, F.col("g") == F.col("of"), "left_semi"), "suffix-shared")
    distinct = staged(shared.groupBy("g", "u").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "spot")).alias("at")), "suffix-distinct")
    whole = shared.join(distinct.where("n > 1").select(F.col("g").alias("og"), F.col("u").alias("ou")),
                        (F.col("g") == F.col("og")) & (F.col("u") == F.col("ou")), "left_semi")
    lo, more = F.shiftright("spot", 16), F.shiftright("spot", 8).bitwiseAND(F.lit(255))
    covered = whole.select("k1", "k2", lo.alias("begin"), (lo + more + WINDOW).alias("end")).distinct()

    groups = distinct.groupBy("g").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
    groups = groups.where("kinds > 1 AND least = 1").select(
        F.col("g").alias("og"), F.ceil(F.col("kinds") / split_units).cast("long").alias("splits"))
    edge = staged(distinct.join(groups, F.col("g") == F.col("og")).select(
        "at.*", "g", (F.col("n") == 1).alias("open"), "splits", F.pmod("u", "splits").alias("part")), "suffix-edges")
    count = edge.count()
    if not count:
        return covered
    names = ["spot", "g", "open", "splits", "part"]
    by_text = edge.groupBy("k1", "k2").agg(F.collect_list(F.struct(*names)).alias("e")).select(
        "k1", "k2", *[F.col(f"e.{c}").alias(c) for c in names])
    involved = docs.where(F.octet_length(text) >= WINDOW).select(*_key(text), text.alias("text"))
    keys = edge.select(F.col("k1").alias("a"), F.col("k2").alias("b")).distinct()
    involved = involved.join(keys, (F.col("k1") == F.col("a")) & (F.col("k2") == F.col("b")), "left_semi")
    involved = involved.groupBy(F.col("k1").alias("a"), F.col("k2").alias("b")).agg(F.first("text").alias("text"))
    shards = max(1, -(-count * (WINDOW + RUNS // 2) // shard_bytes))
    cut = by_text.join(involved, (F.col("k1") == F.col("a")) & (F.col("k2") == F.col("b"))).select("k1", "k2", *names, "text")

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.diff(batch.column("spot").offsets.to_numpy())
            spots = batch.column("spot").flatten()
            spot = spots.to_numpy()
            begin, at, out = spot >> 16, 0, []
            end = begin + (spot >> 8 & 255) + WINDOW
            for text_, n in zip(batch.column("text"), counts.tolist()):
                data = text_.as_py().encode("utf-8", "surrogatepass")
                out += [data[a:b] for a, b in zip(begin[at:at + n].tolist(), end[at:at + n].tolist())]
                at += n
            row = pa.array(np.repeat(np.arange(len(counts)), counts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("k1").take(row), batch.column("k2").take(row), spots,
                 *[batch.column(c).flatten() for c in names[1:]], pa.array(out, pa.binary())],
                names=["k1", "k2", *names, "data"])

    with small_batches(docs.sparkSession):
        bytes_ = staged(cut.mapInArrow(
            slices, "k1 long, k2 long, spot long, g long, open boolean, splits long, part long, data binary"), "suffix-bytes")
    shard = F.pmod(F.xxhash64("g", "part"), F.lit(shards))
    judged = staged(bytes_.withColumn("shard", shard).groupBy("shard").applyInPandas(
        _judge_shard, "kind int, k1 long, k2 long, begin long, last long, g long, shard long, print long, open boolean"), "suffix-judged")
    inside = judged.where("kind = 0").select("k1", "k2", "begin", (F.col("last") + WINDOW).alias("end"))
    foreign = judged.where("kind = 1")
    if foreign.limit(1).count():
        # a shard's copies of a window are one row, so that a window in very many texts has as many rows as there are shards
        prints = foreign.select("print", "shard").distinct().withColumn("bucket", F.pmod("print", F.lit(shards)))
        both = staged(prints.groupBy("bucket").applyInPandas(_merge_shards, "shared long"), "suffix-merged")
        merged = foreign.where("open").join(both, F.col("print") == F.col("shared"), "left_semi")
        inside = inside.unionByName(merged.select("k1", "k2", "begin", (F.col("begin") + WINDOW).alias("end")))
    return covered.unionByName(inside)


def _judge_shard(rows: pd.DataFrame) -> pd.DataFrame:
    """kind 0: windows of open units that repeat inside the shard. kind 1: windows of split groups, with their hashes."""
    counts = (rows["spot"].to_numpy() >> 8 & 255) + 1
    parts = [bytes(x) for x in rows["data"]]
    again = repeated_windows(parts, counts)
    out = []
    for k1, k2, spot, g, open_, splits, shard, data, hit in zip(
            rows["k1"], rows["k2"], rows["spot"], rows["g"], rows["open"], rows["splits"], rows["shard"], parts, again):
        lo = spot >> 16
        if open_ and hit.any():
            edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
            out.append(pd.DataFrame({"kind": 0, "k1": k1, "k2": k2, "begin": edges[0::2] + lo, "last": edges[1::2] - 1 + lo,
                                     "g": g, "shard": shard, "print": 0, "open": True}))
        if splits > 1:
            at = np.arange(len(hit))
            prints = run_hashes(np.frombuffer(data, np.uint8), at, at + WINDOW).view(np.int64)
            out.append(pd.DataFrame({"kind": 1, "k1": k1, "k2": k2, "begin": at + lo, "last": at + lo, "g": g, "shard": shard,
                                     "print": prints, "open": open_ & ~hit}))
    names = ["kind", "k1", "k2", "begin", "last", "g", "shard", "print", "open"]
    return pd.concat(out)[names] if out else pd.DataFrame({n: [] for n in names})


def _merge_shards(rows: pd.DataFrame) -> pd.DataFrame:
    """Windows (by hash) that several shards hold: each shard's sorted windows are sought in those of the shards before it."""
    found = []
    before = np.zeros(0, dtype=np.int64)
    for _, part in rows.groupby("shard"):
        own = np.sort(part["print"].to_numpy())
        if len(before):
            at = np.minimum(np.searchsorted(before, own), len(before) - 1)
            seen = before[at] == own
            found.append(own[seen])
            own = own[~seen]
        before = np.insert(before, np.searchsorted(before, own), own)
    return pd.DataFrame({"shared": np.unique(np.concatenate(found)) if found else before[:0]})


def cut_spans(data: bytes, begins: np.ndarray, ends: np.ndarray) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and what is left."""
    order = np.argsort(begins, kind="stable")
    begins, reach = begins[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], begins[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    starts, stops = begins[first], reach[np.append(first[1:], len(begins)) - 1]
    left, at = [], 0
    for a, b in zip(starts, stops):
        left.append(data[at:a])
        at = b
    left.append(data[at:])
    return int((stops - starts).sum()), len(starts), b"".join(left)


def _merged_spans(ranges: DataFrame) -> DataFrame:
    """a, b (text), and begin, end: the maximal runs of each text, however many ranges overlap in them."""
    text = W.partitionBy("k1", "k2").orderBy("begin", "end")
    reach = F.max("end").over(text.rowsBetween(W.unboundedPreceding, -1))
    runs = ranges.withColumn("new", F.when(F.col("begin") <= reach, 0).otherwise(1))
    runs = runs.withColumn("run", F.sum("new").over(text.rowsBetween(W.unboundedPreceding, 0)))
    runs = runs.groupBy("k1", "k2", "run").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    return runs.groupBy(F.col("k1").alias("a"), F.col("k2").alias("b")).agg(F.collect_list(F.struct("begin", "end")).alias("s")).select(
        "a", "b", "s.begin", "s.end")


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, **settings) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 of every document; with ``with_text`` the remaining text, where bytes
    that are no longer valid UTF-8 become U+FFFD."""
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    by_text = staged(_merged_spans(spans(docs, text, **settings)), "suffix-spans")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), *_key(text), text.alias("text"))
    joined = rows.join(by_text, (F.col("k1") == F.col("a")) & (F.col("k2") == F.col("b")), "left").select("id", "text", "begin", "end")
    kind = docs.select(F.col(f"`{id_col}`").alias("id")).schema[0].dataType.simpleString()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text_, begin, end in zip(batch["text"], batch["begin"], batch["end"]):
                data = text_.encode("utf-8", "surrogatepass")
                n, runs, left = (0, 0, data) if begin is None else cut_spans(data, np.asarray(begin), np.asarray(end))
                out.append((len(data), n, runs, hashlib.sha256(left).hexdigest(),
                            left.decode("utf-8", "replace") if with_text else None))
            table = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
            table.insert(0, "id", batch["id"].array)
            yield table if with_text else table.drop(columns="kept")

    schema = f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept string" * with_text
    return joined.mapInPandas(cut, schema).withColumnRenamed("id", id_col)
