"""Vectorised hashing of words and byte runs, for use inside tasks."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np

CHUNK = 2_000_000
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64 and of its inverse."""
    def run(step: int) -> np.ndarray:
        out = np.full(size, step, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)
    return run(_BASE), run(pow(_BASE, -1, 1 << 64))


@functools.cache
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end]; equal runs have equal hashes wherever they stand."""
    size = 1 << max(16, int(len(data)).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_byte_values()[data] * up[:len(data)], out=sums[1:])
    lengths = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * down[starts] + lengths)


def chunks(texts: list[str], size: int = CHUNK) -> Iterator[tuple[list[int], list[bytes]]]:
    """Whole texts as bytes, in groups of about ``size`` bytes; a longer text is a group of its own."""
    rows, held, total = [], [], 0
    for row, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass")
        if held and total + len(data) > size:
            yield rows, held
            rows, held, total = [], [], 0
        rows.append(row)
        held.append(data)
        total += len(data) + 1
    if held:
        yield rows, held


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word, in order. Words are runs of bytes other than 9 to 13 and 32."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    bounds = np.cumsum([len(t) + 1 for t in texts])
    return run_hashes(data, starts, ends), np.searchsorted(bounds, starts, side="right")


def shingle_counts(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash, count) of every distinct run of ``width`` words, sorted; shorter texts are one run."""
    words, owner = word_hashes(texts)
    odd = mix(np.arange(11, 11 + width, dtype=np.uint64)) | np.uint64(1)
    n = max(0, len(words) - width + 1)
    run = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        run += words[k:k + n] * odd[k]
    whole = owner[:n] == owner[width - 1:width - 1 + n]
    hashes, owners = mix(run[whole]), owner[:n][whole]
    sizes = np.bincount(owner, minlength=len(texts))
    begin = np.cumsum(sizes) - sizes
    short = np.flatnonzero((sizes > 0) & (sizes < width))
    if len(short):
        extra = [np.uint64(int((words[begin[t]:begin[t] + sizes[t]] * odd[:sizes[t]]).sum(dtype=np.uint64)) ^ int(sizes[t]))
                 for t in short]
        hashes = np.concatenate([hashes, mix(np.array(extra, dtype=np.uint64))])
        owners = np.concatenate([owners, short])
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    order = np.argsort(mix(hashes ^ (owners.astype(np.uint64) * np.uint64(_BASE))), kind="stable")
    hashes, owners = hashes[order], owners[order]
    new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(hashes)))
    hashes, owners = hashes[at], owners[at]
    by_text = np.argsort(owners, kind="stable")
    return owners[by_text], hashes[by_text], counts[by_text]
