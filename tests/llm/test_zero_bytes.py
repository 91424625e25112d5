"""Suffix arrays of data that end in zeros."""

import numpy as np
import pytest

from churnlake.llm import suffix_dedup


@pytest.mark.parametrize("data", [b"\0", b"\0" * 2, b"\0" * 40, b"ab\0\0\0", b"\0" * 9 + b"ab" + b"\0" * 9, b"a\0" * 30, b"ab\0" * 9 + b"\0" * 20])
def test_order(data):
    order = suffix_dedup.suffix_order(np.frombuffer(data, np.uint8))
    assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])


def test_windows_of_zeros():
    parts = [b"x" * 3 + b"\0" * 300, b"y" * 3 + b"\0" * 300]
    found = suffix_dedup.repeated_windows(parts, np.array([104, 104]))
    assert [f.tolist() for f in found] == [[False] * 3 + [True] * 101] * 2
