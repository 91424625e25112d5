"""Repair of the turn structure of conversations at least cost, by a parallel Viterbi search with rank convergence.

The rows of a conversation, by turn (nulls first), must spell roles ``(s?(ua)+)?`` after these edits:

======  ====  =================================================================================
letter  cost  edit
======  ====  =================================================================================
K       0     keep the row; its role's first letter must be the one expected
R       1     keep the row with another role, user or assistant
D       2     delete the row; blank rows and duplicates of earlier rows must be deleted
I       5     insert an empty user or assistant row, anywhere
======  ====  =================================================================================

A truncated row (last character that is not white space not in ``.!?``) that is not deleted costs 5 more. What may follow
depends only on the state (nothing yet, after s, after u, after a), so that the cheapest completion from every row is a
vector of four costs, computed from the last row to the first.

*Rows into chunks.* Rows are sorted by ranges over the cluster, so that a very long conversation spreads over many
partitions, and cut into chunks of at most ``CHUNK`` rows; only a code of one byte per row goes on, not the text.

*Backward.* The last chunk of a conversation starts from the true vector, all others from a speculative one (zeros).
Then fix-up passes: a chunk whose successor's first vector, up to a constant, is not the one it started from runs again
from it, until its vectors differ from those it had before by a constant only; what lies further on can then not change
but by that constant. Passes end when no chunk has to run again. Where a long stretch never converges (rows that all are
deleted hand any vector through), ``PASSES`` passes are made; for the chunks left, the min-plus products of their rows are
composed over 1, 2, 4, ... chunks, which gives their vectors exactly in a logarithmic number of steps.

*Forward.* From the backward costs every chunk finds the state it ends in for each state it may start in. Where these
differ, the maps are composed over 1, 2, 4, ... chunks, until each chunk knows its first state; it then traces its edits,
taking the least letter of those that stay on a cheapest way. A trace is a string of at most three letters per row.

Defined results: null role and text are read as given by ``missing``, a null key is a conversation of its own, rows of one
turn are ordered by role and the MD5 of their text; a conversation without rows has no row in the result; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from churnlake.llm.common import SPACES, ship_package, staged

CHUNK = 64
PASSES = 3
KEEP, RENAME, DELETE, INSERT, OPEN = 0, 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
#: What follows a state when u or a is put after it; states: 0 nothing, 1 after s, 2 after u, 3 after a.
PUT = np.array([2, 2, 3, 2])
#: Costs of ending in a state, with the rows to insert.
END = np.array([0, 2 * INSERT, INSERT, 0], np.int64)
FAR = 1 << 40
#: Codes of rows: nothing, must go, then s, u, a, other whole and truncated.
NOTHING, GONE, CODES = 0, 1, 10


def _kept_state(code: int) -> np.ndarray:
    """The state after keeping a row of that code in each state, -1 where it cannot be kept."""
    role = (code - 2) // 2 if code > GONE else 3
    return np.array([[1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1], [-1] * 4][role])


def _inserted() -> np.ndarray:
    """Costs from state to state by inserts alone."""
    costs = np.full((4, 4), FAR, np.int64)
    for q in range(4):
        costs[q, q] = 0
        costs[q, PUT[q]] = min(costs[q, PUT[q]], INSERT)
        costs[q, PUT[PUT[q]]] = min(costs[q, PUT[PUT[q]]], 2 * INSERT)
    return costs


def _row_costs(code: int) -> np.ndarray:
    """Costs from state to state over one row, inserts before it included."""
    own = np.full((4, 4), FAR, np.int64)
    if code == NOTHING:
        np.fill_diagonal(own, 0)
        return own
    np.fill_diagonal(own, DELETE)
    if code > GONE:
        more, keeps = OPEN * (code % 2), _kept_state(code)
        for q in range(4):
            own[q, PUT[q]] = min(own[q, PUT[q]], RENAME + more)
            if keeps[q] >= 0:
                own[q, keeps[q]] = min(own[q, keeps[q]], KEEP + more)
    return product(_inserted()[None], own[None])[0]


def product(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Min-plus products of 4 x 4 matrices."""
    return np.minimum((first[:, :, :, None] + second[:, None, :, :]).min(axis=2), FAR)


STEP = np.stack([_row_costs(code) for code in range(CODES)])
KEPT = np.stack([_kept_state(code) for code in range(CODES)])


def _code_table(codes: list[bytes]) -> np.ndarray:
    table = np.zeros((len(codes), max(1, max(map(len, codes), default=1))), np.uint8)
    for k, c in enumerate(codes):
        table[k, :len(c)] = np.frombuffer(c, np.uint8)
    return table


def _back(column: np.ndarray, costs: np.ndarray) -> np.ndarray:
    return (STEP[column] + costs[:, None, :]).min(axis=2)


def backward(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Costs to the end before every row and after the last: (rows + 1, chunks, 4)."""
    costs = np.empty((codes.shape[1] + 1, *ends.shape), np.int64)
    costs[-1] = ends
    for at in range(codes.shape[1] - 1, -1, -1):
        costs[at] = _back(codes[:, at], costs[at + 1])
    return costs


def rerun(codes: np.ndarray, old: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first vectors from the ends ``new``, whether they differ from those of ``old`` by more than a constant).

    A chunk leaves the run at the row where both vectors differ by a constant only.
    """
    first, open_ = new.copy(), np.ones(len(new), bool)
    a, b, rows = old.copy(), new.copy(), np.arange(len(new))
    shift = np.zeros(len(new), np.int64)
    start = backward(codes, old)[0]
    for at in range(codes.shape[1] - 1, -1, -1):
        if not len(rows):
            break
        a, b = _back(codes[rows, at], a), _back(codes[rows, at], b)
        gap = b - a
        same = (gap == gap[:, :1]).all(axis=1)
        shift[rows[same]], open_[rows[same]] = gap[same, 0], False
        rows, a, b = rows[~same], a[~same], b[~same]
    first[rows] = b
    closed = ~open_
    first[closed] = start[closed] + shift[closed, None]
    return first, open_


def products(codes: np.ndarray) -> np.ndarray:
    """The min-plus product of the rows of every chunk."""
    out = np.repeat(STEP[NOTHING][None], len(codes), axis=0)
    for at in range(codes.shape[1] - 1, -1, -1):
        out = product(STEP[codes[:, at]], out)
    return out


def trace(codes: np.ndarray, costs: np.ndarray, states: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(letters, states after the chunks): least letters of the cheapest edits; ``last`` chunks end the conversation."""
    n, width = codes.shape
    letters = np.full((n, 3 * width + 2), b"", "S1")
    q, every = states.copy(), np.arange(n)

    def insert(at: int, now: np.ndarray, where: np.ndarray, slot: int) -> None:
        nonlocal q
        put = where & (now[every, q] == INSERT + now[every, PUT[q]])
        letters[put, slot] = b"I"
        q = np.where(put, PUT[q], q)

    for at in range(width):
        now, after, code = costs[at], costs[at + 1], codes[:, at]
        waiting = code != NOTHING
        for slot in (0, 1):
            gone = waiting & (now[every, q] == DELETE + after[every, q])
            letters[gone, 3 * at + slot] = b"D"
            waiting &= ~gone
            insert(at, now, waiting, 3 * at + slot)
        gone = waiting & (now[every, q] == DELETE + after[every, q])
        letters[gone, 3 * at + 2] = b"D"
        waiting &= ~gone
        more = np.where(code % 2 == 1, OPEN, 0)
        to = KEPT[code, q]
        kept = waiting & (to >= 0) & (now[every, q] == KEEP + more + after[every, np.maximum(to, 0)])
        letters[kept, 3 * at + 2] = b"K"
        renamed = waiting & ~kept
        letters[renamed, 3 * at + 2] = b"R"
        q = np.where(kept, to, np.where(renamed, PUT[q], q))
    for slot in (0, 1):
        insert(width, np.broadcast_to(END, (n, 4)), last & (END[q] > 0), 3 * width + slot)
    return letters, q


# ---- rows and chunks ----


def last_character(text: Column) -> Column:
    """The last character that is not white space; empty for a blank text."""
    return F.substring(F.rtrim(text, F.lit(SPACES)), -1, 1)


def faults(rows: DataFrame, key: str, turn: str, role: str, text: str, missing: str) -> DataFrame:
    """key, turn, role letter, digest, blank, cut (truncated) and place of every row, sorted by ranges and written."""
    words = F.coalesce(F.col(f"`{text}`"), F.lit(missing))
    role_text = F.coalesce(F.col(f"`{role}`"), F.lit(missing))
    tail = last_character(words)
    ready = rows.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{turn}`").alias("turn"), role_text.alias("role"), F.md5(words).alias("digest"),
        (tail == "").alias("blank"), ((tail != "") & ~tail.isin(".", "!", "?")).alias("cut"))
    order = [F.col("key").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest"]
    placed = ready.repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(placed.withColumn("at", F.monotonically_increasing_id()), "turns")


def chunks(placed: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Chunks of the rows of ``faults``, numbered within their conversation; written."""
    firsts = placed.where("NOT blank").groupBy("key", "role", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    kinds = placed.join(firsts, "at", "left").select(
        "key", "turn", "at", "blank", F.expr("NOT blank AND first IS NULL").alias("duplicate"),
        F.expr("cut AND first IS NOT NULL").alias("truncated"), F.substring("role", 1, 1).alias("initial"))
    code = F.expr(f"CASE WHEN blank OR duplicate THEN {GONE} ELSE "
                  "2 + 2 * (CASE initial WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END) + int(truncated) END")
    part = F.shiftright("at", 33)
    held = kinds.groupBy("key", part.alias("part"), F.expr(f"at div {chunk}").alias("cell")).agg(
        F.array_sort(F.collect_list(F.struct("at", code.alias("code"), "initial", "turn"))).alias("rows"),
        *[F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated")])
    legal = "concat(x.initial, y.initial) IN ('su', 'ua', 'au')"
    held = held.select(
        "key", "part", "cell", "blank", "duplicate", "truncated",
        F.expr("unhex(array_join(transform(rows, r -> lpad(hex(r.code), 2, '0')), ''))").alias("codes"),
        F.expr(f"size(filter(zip_with(slice(rows, 1, size(rows) - 1), slice(rows, 2, size(rows)), (x, y) -> NOT {legal}), b -> b))")
        .cast("long").alias("illegal"),
        F.expr("size(array_distinct(filter(transform(rows, r -> r.turn), t -> t IS NOT NULL)))").cast("long").alias("turns"),
        F.expr("array_min(transform(rows, r -> r.turn))").alias("low"), F.expr("array_max(transform(rows, r -> r.turn))").alias("high"),
        F.expr("rows[0].initial").alias("head"), F.expr("rows[size(rows) - 1].initial").alias("tail"))
    held = staged(held, "turn-chunks")
    spans = held.groupBy("key", "part").agg(F.min("cell").alias("start"), F.count(F.lit(1)).alias("n"))
    # one row for each partition that a conversation reaches into
    whole, earlier = W.partitionBy("key"), W.partitionBy("key").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    spans = spans.select(F.col("key").alias("k"), F.col("part").alias("p"), "start",
                         F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("chunks"))
    numbered = held.join(spans, F.col("key").eqNullSafe(F.col("k")) & (F.col("part") == F.col("p")))
    return staged(numbered.select(
        *held.columns, (F.col("before") + F.col("cell") - F.col("start")).alias("no"), "chunks"), "turn-chunks")


def _shifted(held: DataFrame, other: DataFrame, step: int, names: dict[str, str]) -> DataFrame:
    """``held`` with columns of the chunk ``step`` further on, null behind the last."""
    beside = other.select(F.col("key").alias("k"), (F.col("no") - step).alias("m"), *[F.col(a).alias(b) for a, b in names.items()])
    return held.join(beside, F.col("key").eqNullSafe(F.col("k")) & (F.col("no") == F.col("m")), "left").drop("k", "m")


def _mapped(df: DataFrame, function: Callable[[pd.DataFrame], dict], schema: str) -> DataFrame:
    """Columns added to every row, or put in place of others, by ``function`` of a batch; the key is handed through as it is."""
    added = [part.split()[0] for part in schema.split(", ")]
    kept = [f for f in df.schema if f.name not in added]
    used = [c for c in df.columns if c != "key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch])
                new = function(table.select(used).to_pandas())
                columns = [table[f.name].combine_chunks() for f in kept] + [pa.array(new[name]) for name in added]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept] + added)

    return df.mapInArrow(run, ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in kept] + [schema]))


def _vectors(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.int64).reshape(len(column), -1)


def _least(vectors: np.ndarray) -> np.ndarray:
    return vectors - vectors.min(axis=1, keepdims=True)


# ---- the two directions ----


def backward_vectors(held: DataFrame, passes: int = PASSES) -> DataFrame:
    """key, no, chunks, codes, ends: the true costs after every chunk, up to a constant."""
    def speculate(batch: pd.DataFrame) -> dict:
        last = (batch["no"] == batch["chunks"] - 1).to_numpy()
        ends = np.where(last[:, None], END[None], 0)
        first = backward(_code_table(batch["codes"].tolist()), ends)[0]
        return {"ends": list(ends), "first": list(_least(first))}

    def again(batch: pd.DataFrame) -> dict:
        codes, old, new = _code_table(batch["codes"].tolist()), _vectors(batch["ends"]), _vectors(batch["next"])
        return {"ends": list(new), "first": list(_least(rerun(codes, old, new)[0]))}

    shape = "ends array<bigint>, first array<bigint>"
    state = staged(_mapped(held.select("key", "no", "chunks", "codes"), speculate, shape), "viterbi-0")
    tried = 0
    while True:
        beside = _shifted(state, state, 1, {"first": "next"}).withColumn("stale", F.coalesce(F.col("next") != F.col("ends"), F.lit(False)))
        stale = beside.where("stale")
        if not stale.limit(1).count():
            return state.select("key", "no", "chunks", "codes", "ends")
        if tried == passes:
            return _composed(beside)
        done = beside.where("NOT stale").drop("stale", "next")
        state = staged(done.unionByName(_mapped(stale.drop("stale"), again, shape).drop("next")), "viterbi")
        tried += 1


def _composed(state: DataFrame) -> DataFrame:
    """The vectors of chunks that passes did not settle, from products over 1, 2, 4, ... chunks.

    ``over`` is the product from a chunk's first row to the end of the chunks composed so far; it is complete when these
    reach the end of the conversation, and the vector is then that product applied to the true costs of the end.
    """
    def start(batch: pd.DataFrame) -> dict:
        return {"over": list(products(_code_table(batch["codes"].tolist())).reshape(len(batch), 16))}

    def join(batch: pd.DataFrame) -> dict:
        has = batch["further"].notna().to_numpy()
        over = _vectors(batch["over"])
        if has.any():
            a, b = over[has].reshape(-1, 4, 4), _vectors(batch["further"][has]).reshape(-1, 4, 4)
            c = product(a, b)
            over[has] = (c - c.min(axis=(1, 2), keepdims=True)).reshape(-1, 16)
        return {"over": list(over)}

    def close(batch: pd.DataFrame) -> dict:
        has = batch["further"].notna().to_numpy()
        ends = np.repeat(END[None], len(batch), axis=0)
        if has.any():
            over = _vectors(batch["further"][has]).reshape(-1, 4, 4)
            ends[has] = _least((over + END[None, None, :]).min(axis=2))
        return {"ends": list(ends)}

    # only conversations with an unsettled chunk
    loose = state.where("stale").select(F.col("key").alias("k")).distinct()
    match = F.col("key").eqNullSafe(F.col("k"))
    settled = state.join(loose, match, "left_anti").select("key", "no", "chunks", "codes", "ends")
    rest = state.join(loose, match, "left_semi").select("key", "no", "chunks", "codes")
    over = staged(_mapped(rest, start, "over array<bigint>"), "viterbi-products")
    longest, step = over.agg(F.max("chunks")).first()[0], 1
    while step < longest:
        over = staged(_mapped(_shifted(over, over, step, {"over": "further"}), join, "over array<bigint>").drop("further"), "viterbi-products")
        step *= 2
    closed = _mapped(_shifted(over, over, 1, {"over": "further"}), close, "ends array<bigint>")
    return staged(settled.unionByName(closed.select("key", "no", "chunks", "codes", "ends")), "viterbi")


def traced(vectors: DataFrame) -> DataFrame:
    """key, no, audit, cost of every chunk."""
    def maps(batch: pd.DataFrame) -> dict:
        codes, n = _code_table(batch["codes"].tolist()), len(batch)
        costs = backward(codes, _vectors(batch["ends"]))
        last = np.zeros(n, bool)
        return {"goes": list(np.stack([trace(codes, costs, np.full(n, q), last)[1] for q in range(4)], axis=1))}

    def compose(batch: pd.DataFrame) -> dict:
        has, goes = batch["further"].notna().to_numpy(), _vectors(batch["goes"])
        if has.any():
            goes[has] = np.take_along_axis(goes[has], _vectors(batch["further"][has]), axis=1)
        return {"goes": list(goes)}

    def audits(batch: pd.DataFrame) -> dict:
        codes = _code_table(batch["codes"].tolist())
        costs = backward(codes, _vectors(batch["ends"]))
        letters, _ = trace(codes, costs, batch["start"].to_numpy(np.int64), (batch["no"] == batch["chunks"] - 1).to_numpy())
        stays = np.isin(letters[:, 2:3 * codes.shape[1]:3], [b"K", b"R"])  # the third place of every row
        paid = {b"R": RENAME, b"D": DELETE, b"I": INSERT}
        cost = sum(price * (letters == letter).sum(axis=1) for letter, price in paid.items())
        cost = cost + OPEN * (stays & (codes > GONE) & (codes % 2 == 1)).sum(axis=1)
        return {"audit": [b"".join(row).decode() for row in letters.tolist()], "cost": cost.astype(np.int64)}

    shape = "goes array<bigint>"
    long_ = vectors.where("chunks > 1")
    goes, step = staged(_mapped(long_, maps, shape).select("key", "no", "goes"), "viterbi-states"), 1
    # a map whose four states are one, or that begins at the conversation's first chunk, is final
    while goes.where(f"no >= {step} AND size(array_distinct(goes)) > 1").limit(1).count():
        goes = staged(_mapped(_shifted(goes, goes, -step, {"goes": "further"}), compose, shape).select("key", "no", "goes"), "viterbi-states")
        step *= 2
    starts = _shifted(vectors, goes, -1, {"goes": "goes"})
    placed = starts.withColumn("start", F.coalesce(F.expr("goes[0]"), F.lit(0))).drop("goes")
    return _mapped(placed, audits, "audit string, cost bigint").select("key", "no", "audit", "cost")


def repair(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           missing: str = " ", chunk: int = CHUNK, passes: int = PASSES) -> DataFrame:
    """key, gaps, blank, duplicate, truncated, illegal, cost, audit of every conversation."""
    ship_package(rows.sparkSession)
    held = chunks(faults(rows, key, turn, role, text, missing), chunk)
    audits = staged(traced(backward_vectors(held, passes)), "turn-audits")
    seams = _shifted(held, held, -1, {"tail": "earlier_tail", "high": "earlier_high"})
    seams = seams.withColumns({
        "illegal": F.col("illegal") + F.expr("int(coalesce(concat(earlier_tail, head) NOT IN ('su', 'ua', 'au'), false))"),
        "turns": F.col("turns") - F.expr("int(coalesce(earlier_high = low, false))")})
    whole = seams.groupBy("key").agg(
        F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("turns"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    edits = audits.groupBy("key").agg(F.sum("cost").alias("cost"), F.array_sort(F.collect_list(F.struct("no", "audit"))).alias("parts")).select(
        F.col("key").alias("k"), "cost", F.expr("array_join(transform(parts, p -> p.audit), '')").alias("audit"))
    return whole.join(edits, F.col("key").eqNullSafe(F.col("k"))).drop("k").withColumnRenamed("key", key)


class Edits:
    """Applies one conversation's audit to its rows as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0

    def _put(self) -> str:
        self.state = int(PUT[self.state])
        return ROLES["u" if self.state == 2 else "a"]

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._put(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter == "R":
            yield self._put(), text
        elif letter == "K":
            self.state = {"s": 1, "u": 2, "a": 3}[role[0]]
            yield role, text


class RowSink:
    """The repaired rows themselves."""

    shape = "place long, role string, text string"

    def __init__(self):
        self.place = 0

    def add(self, role: str, text: str) -> list[tuple]:
        self.place += 1
        return [(self.place - 1, role, text)]

    def end(self) -> list[tuple]:
        return []


class HashSink:
    """SHA-256 of ``role:text`` of all rows, joined by newlines."""

    shape = "repaired_sha256 string"

    def __init__(self):
        self.hash, self.between = hashlib.sha256(), ""

    def add(self, role: str, text: str) -> list[tuple]:
        self.hash.update(f"{self.between}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.between = "\n"
        return []

    def end(self) -> list[tuple]:
        return [(self.hash.hexdigest(),)]


def applied(rows: DataFrame, repaired: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text", missing: str = " ", sink: type = RowSink) -> DataFrame:
    """The audits of ``repair`` applied to the rows: key and what the sink makes of a conversation's repaired rows.

    The rows of a conversation stream in order through one task, and only the current one is held: a checksum over a
    whole conversation has to see its rows one after the other. Keys must keep their value as text.
    """
    ship_package(rows.sparkSession)
    words = F.coalesce(F.col(f"`{text}`"), F.lit(missing))
    turns = rows.select(
        F.col(f"`{key}`").alias("key"), F.lit(1).alias("kind"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(missing)).alias("role"), F.md5(words).alias("digest"), words.alias("text"))
    heads = repaired.select(F.col(f"`{key}`").alias("key"), F.lit(0).alias("kind"), F.col("audit").alias("text"))
    order = ["key", "kind", F.col("turn").asc_nulls_first(), "role", "digest"]
    ordered = turns.unionByName(heads, allowMissingColumns=True).repartition("key").sortWithinPartitions(*order)
    names = ["key", *[part.split()[0] for part in sink.shape.split(", ")]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, edits, out = None, None, None
        for batch in batches:
            made = []
            for k, kind, role, text in zip(batch["key"], batch["kind"], batch["role"], batch["text"]):
                if kind == 0:  # the audit comes before the rows
                    if edits is not None:
                        made += [(key, *row) for r in edits.inserted() for row in out.add(*r)]
                        made += [(key, *row) for row in out.end()]
                    key, edits, out = k, Edits(text), sink()
                else:
                    made += [(key, *row) for r in edits.row(role, text) for row in out.add(*r)]
            if made:
                yield pd.DataFrame(made, columns=names)
        if edits is not None:
            made = [(key, *row) for r in edits.inserted() for row in out.add(*r)] + [(key, *row) for row in out.end()]
            if made:
                yield pd.DataFrame(made, columns=names)

    kind = rows.schema[key].dataType.simpleString()
    plain = ordered.select(F.col("key").cast("string").alias("key"), "kind", "role", "text")
    return plain.mapInPandas(run, f"key string, {sink.shape}").withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)


def damaged(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            missing: str = " ") -> DataFrame:
    """Rows with seeded faults, by a checksum of key and turn: dropped, emptied, cut, repeated or with another role."""
    def text_of(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(missing))

    luck = F.pmod(F.crc32(F.concat(text_of(key), F.lit(":"), text_of(turn))), F.lit(20))
    marked = rows.select(F.col(f"`{key}`").alias(key), F.col(f"`{turn}`").alias(turn), text_of(role).alias(role),
                         text_of(text).alias(text), luck.alias("__luck")).where("__luck <> 0")
    changed = marked.select(
        key, turn, F.when(F.col("__luck") == 4, "user").otherwise(F.col(role)).alias(role),
        F.when(F.col("__luck") == 1, "").when(F.col("__luck") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(F.col(text)).alias(text),
        F.explode(F.expr("array_repeat(1, CASE WHEN __luck = 3 THEN 2 ELSE 1 END)")).alias("__copy"))
    return changed.drop("__copy")
