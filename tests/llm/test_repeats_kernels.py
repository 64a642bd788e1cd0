"""The kernels of the suffix dedup against plain Python, without a session."""

import numpy as np
import pytest

from pagelens.llm import repeats, suffixes


@pytest.mark.parametrize("size", [1, 2, 3, 7, 8, 9, 15, 16, 17, 63, 64])
def test_grams_are_equal_where_strings_are(size):
    rng = np.random.default_rng(size)
    part = rng.integers(0, 3, 90, dtype=np.uint8)
    data = np.concatenate([part, rng.integers(0, 256, 50, dtype=np.uint8), part])
    strings = [data[i : i + size].tobytes() for i in range(len(data) - size + 1)]
    hashes = repeats._grams(data, size).tolist()
    assert len(hashes) == len(strings)
    assert len(set(zip(strings, hashes))) == len(set(strings)) == len(set(hashes))


def test_common_prefixes_in_memory():
    rng = np.random.default_rng(5)
    for n, symbols, cap in [(1, 1, 3), (2, 1, 1), (60, 1, 7), (200, 2, 5), (200, 3, 64), (150, 2, 500)]:
        t = np.append(np.tile(rng.integers(1, symbols + 1, max(1, n // 3)), 3)[: n - 1], 0)
        order, values = suffixes._in_memory(t, cap)
        plain = t.tolist()
        assert order.tolist() == sorted(range(len(plain)), key=lambda i: plain[i:])
        for x, y, v in zip(order[:-1].tolist(), order[1:].tolist(), values[1:].tolist()):
            same = 0
            while max(x, y) + same < len(plain) and plain[x + same] == plain[y + same]:
                same += 1
            assert v == min(same, cap)
