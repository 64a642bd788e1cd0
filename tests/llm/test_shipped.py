"""What travels to the executors stays small, also after the driver itself has used the kernels."""

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from pagelens.llm import fim, groups, licenses, linededup, neardup, packing, periods, pii, quality, repeats, secrets, suffixes, text, toxicity, urls


def test_functions_are_small_when_pickled():
    batch = pa.array(["some words of a text\nand another line"] * 3)
    for group in text.chunked(batch):
        quality.cascade(group, list(quality.RULES))
    assert text._cache
    for module in (fim, groups, licenses, linededup, neardup, packing, periods, pii, quality, repeats, secrets, suffixes, text, toxicity, urls):
        for name, value in vars(module).items():
            if callable(value) and getattr(value, "__module__", "") == module.__name__:
                assert len(cloudpickle.dumps(value)) < 200_000, (module.__name__, name)


def test_long_crafted_strings_have_different_hashes():
    a, b = np.array([97], np.uint8), np.array([98], np.uint8)
    for _ in range(12):  # such a pair collides for every odd base modulo a power of two
        a, b = np.concatenate([a, b]), np.concatenate([b, a])
    ends = np.array([len(a)])
    assert text.Hasher(a)(np.array([0]), ends) != text.Hasher(b)(np.array([0]), ends)
