"""Repairs agree with a plain search over whole conversations, however they are cut into chunks."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from churnlake.llm import conversation_repair as repair
from churnlake.llm.queries import QUERIES


def brute_damage(rows):
    out = defaultdict(list)
    for key, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        luck = zlib.crc32(f"{' ' if key is None else key}:{' ' if turn is None else turn}".encode()) % 20
        if luck == 0:
            out[key] += []
            continue
        if luck == 1:
            text = ""
        if luck == 2:
            text = re.sub("[.!?]", "", text)
        if luck == 4:
            role = "user"
        out[key] += [(turn, role, text)] * (2 if luck == 3 else 1)
    return out


def brute(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, repaired of one conversation."""
    if not rows:
        return 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    seen, fault = set(), []
    for _, role, text in rows:
        tail = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        fault.append("b" if not tail else "d" if (role, text) in seen else "t" if tail not in ".!?" else "")
        seen.add((role, text))
    follows = {0: "su", 1: "u", 2: "a", 3: "u"}
    to = {"s": 1, "u": 2, "a": 3}
    best = [dict() for _ in range(len(rows) + 1)]  # state -> (cost, audit, repaired rows)

    def better(table, state, entry):
        if state not in table or entry[:2] < table[state][:2]:
            table[state] = entry
            return True
        return False

    def with_inserts(table):
        for _ in range(3):
            for q, (cost, audit, made) in list(table.items()):
                for p in range(4):
                    for c in follows[p]:
                        if c != "s" and to[c] == q:
                            better(table, p, (cost + 5, "I" + audit, [("user" if c == "u" else "assistant", "")] + made))

    best[-1] = {0: (0, "", []), 3: (0, "", [])}
    with_inserts(best[-1])
    for i in range(len(rows) - 1, -1, -1):
        role, text = rows[i][1:]
        for q in range(4):
            if q in best[i + 1]:
                cost, audit, made = best[i + 1][q]
                better(best[i], q, (cost + 2, "D" + audit, made))
            if fault[i] not in ("b", "d"):
                more = 5 if fault[i] == "t" else 0
                for c in follows[q]:
                    if to[c] not in best[i + 1]:
                        continue
                    cost, audit, made = best[i + 1][to[c]]
                    if role[:1] == c:
                        better(best[i], q, (cost + more, "K" + audit, [(role, text)] + made))
                    if c != "s":
                        better(best[i], q, (cost + 1 + more, "R" + audit, [("user" if c == "u" else "assistant", text)] + made))
        with_inserts(best[i])
    cost, audit, made = best[0][0]
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    text = "\n".join(f"{r}:{t}" for r, t in made)
    return (gaps, fault.count("b"), fault.count("d"), fault.count("t"), illegal, cost, audit,
            hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def test_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = {k: brute(v) for k, v in brute_damage(rows).items()}
    found = {r.conv_id: tuple(r[c] for c in (*COLUMNS, "repaired_sha256")) for r in QUERIES["op13_conversation_repair"](spark, folder).collect()}
    assert found == expected


def some_conversations(seed, n=60):
    luck, out = random.Random(seed), {}
    for k in range(n):
        kind, rows = luck.randrange(5), []
        for t in range(luck.choice([1, 2, 7, 30, 90])):
            role = luck.choice(["user", "assistant", "system", "tool", "", "u"]) if kind else ["user", "assistant"][t % 2]
            text = luck.choice(["Yes.", "no", "", " \t", "Why? ", f"text {t}!", f"cut {t}", "ça va ?"])
            if kind == 2:
                text = "same."
            if kind == 3:
                text = f"cut {t}"
            turn = luck.choice([t, t, t, None, t + 3, t // 2])
            rows.append((turn, role, text))
        out[k if k else None] = rows
    return out


@pytest.mark.parametrize("chunk,passes", [(64, 3), (4, 3), (4, 0), (1, 1), (8, 1)])
def test_chunks(spark, chunk, passes):
    """Long runs of rows that must go hand any vector through: the passes do not settle them."""
    made = some_conversations(chunk + passes)
    rows = [(k, t, r, x, "clash", 1) for k, v in made.items() for t, r, x in v]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, key string, at int")
    fixed = repair.repair(df, chunk=chunk, passes=passes)
    found = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in fixed.collect()}
    assert found == {k: brute(v)[:7] for k, v in made.items()}
    if chunk == 4:
        hashes = {r.conv_id: r.repaired_sha256 for r in repair.applied(df, fixed, sink=repair.HashSink).collect()}
        assert hashes == {k: brute(v)[7] for k, v in made.items()}


def test_hot_conversation(spark):
    """One conversation holds most rows: it spreads over partitions, and long useless stretches stay exact."""
    rows = [(7, t, ["user", "assistant"][t % 2], "same." if 500 < t < 4000 else f"t {t}" if 4500 < t < 6000 else f"t {t}.") for t in range(9000)]
    rows += [(k, 0, "user", "hi.") for k in range(100, 160)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    fixed = repair.repair(df)
    found = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in fixed.collect()}
    assert found[7] == brute([r[1:] for r in rows if r[0] == 7])[:7] and found[101] == brute([(0, "user", "hi.")])[:7]
    assert repair.chunks(repair.faults(df, "conv_id", "turn", "role", "text", " ")).where("key = 7").count() > 100
    turns = repair.applied(df, fixed).where("conv_id = 7").orderBy("place").collect()
    assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in turns))


def test_edges(spark):
    shape = "conv_id string, turn int, role string, text string"
    assert repair.repair(spark.createDataFrame([], shape)).collect() == []
    assert repair.repair(repair.damaged(spark.createDataFrame([], shape))).collect() == []
    long = "word " * 50_000
    rows = [("a", None, None, None), ("a", None, None, None), ("b", 1, "user", long), ("b", 2, "assistant", long + "."), (None, 1, "user", "hi.")]
    found = {r.conv_id: r for r in repair.repair(spark.createDataFrame(rows, shape)).collect()}
    assert (found["a"].audit, found["a"].blank, found["a"].gaps) == ("DD", 2, 0)
    assert (found["b"].audit, found["b"].cost) == ("DD", 4) and found[None].audit == "D"


def test_vectors_that_converge():
    """A rerun leaves as soon as the vectors differ by a constant, and gives the vectors of a whole run."""
    luck = np.random.default_rng(3)
    codes = luck.integers(1, repair.CODES, (200, 32)).astype(np.uint8)
    old, new = np.zeros((200, 4), np.int64), luck.integers(0, 12, (200, 4))
    first, open_ = repair.rerun(codes, old, new)
    assert (first == repair.backward(codes, new)[0]).all() and (~open_).any()
    assert ((repair.products(codes) + new[:, None, :]).min(axis=2) == first).all()
