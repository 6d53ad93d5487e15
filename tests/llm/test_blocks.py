"""Corpus-wide totals of packed counts."""

import numpy as np
import pandas as pd

from riskframe.llm.blocks import packed, packed_sorted, tally, unpacked


def test_totals_beyond_32_bits():
    """Three blocks of 3e9 each: 9e9 in all (a block's own count is below 2 ** 32)."""
    key, count = packed_sorted(np.array([7], np.uint64)), packed(np.array([3_000_000_000], np.uint32))
    asked = pd.DataFrame([(0, 0, b, 0, key, count) for b in range(3)], columns=["kind", "shard", "block", "part", "keys", "counts"])
    out = tally(asked)
    assert [unpacked(x, np.uint64).tolist() for x in out["kept"]] == [[9_000_000_000]] * 3
    assert [unpacked(x, np.uint64).tolist() for x in out["extra"]] == [[0]] * 3
