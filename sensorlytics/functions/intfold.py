"""Running 32-bit integer sum that truncates toward zero at every step (Java ``int += double``).

Used by the ordered integer mean for cells whose readings change sign; the carry depends on
the sign of the running sum, so the fold is sequential. It is evaluated over a cell's
time-sorted readings as they stream past (Arrow batches in ``mapInPandas``), never holding
a whole cell: runs of steps with one rounding direction are done with a numpy cumulative
sum, single scalar steps only where the direction flips or the sum saturates.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd

INT_MAX = 2**31 - 1
INT_MIN = -(2**31)


def _step(acc: int, x: float) -> int:
    t = acc + x
    if t != t:  # NaN narrows to 0
        return 0
    if t >= INT_MAX:
        return INT_MAX
    if t <= INT_MIN:
        return INT_MIN
    return int(math.trunc(t))


def fold(acc: int, values: np.ndarray) -> int:
    """Fold ``values`` (in order) into the running truncated int sum starting at ``acc``."""
    i, m, w = 0, len(values), 64
    while i < m:
        seg = values[i:i + w]
        up = acc + seg[0] >= 0            # the sum stays >= 0: each step adds floor(v)
        steps = np.floor(seg) if up else np.ceil(seg)
        c = acc + np.cumsum(steps)        # running sum after each step if the direction holds
        prev = np.empty_like(c)
        prev[0] = acc
        prev[1:] = c[:-1]
        same = (prev + seg >= 0) if up else (prev + seg < 0)
        ok = same & (c < INT_MAX) & (c > INT_MIN)
        j = len(ok) if bool(ok.all()) else int(np.argmin(ok))
        if j == 0:
            acc = _step(acc, float(seg[0]))
            i += 1
            w = max(64, w // 2)
            continue
        acc = int(c[j - 1])
        i += j
        w = min(w * 2, 1 << 16) if j == len(ok) else max(64, w // 2)
    return acc


def _trunc_div(acc: int, n: int) -> float:
    q = abs(acc) // n
    return float(q if acc >= 0 else -q)


def fold_sorted_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``mapInPandas`` body: rows sorted by (urn, win, timestamp, seq) within the partition
    → one row per cell ``(urn, timestamp = win, value = truncated mean)``."""
    key, acc, n = None, 0, 0
    done: list[tuple] = []
    for pdf in batches:
        if pdf.empty:
            continue
        urn, win, val = pdf["urn"].to_numpy(), pdf["win"].to_numpy(), pdf["value"].to_numpy(dtype=np.float64)
        starts = np.flatnonzero(np.r_[True, (urn[1:] != urn[:-1]) | (win[1:] != win[:-1])])
        ends = np.r_[starts[1:], len(pdf)]
        for s, e in zip(starts, ends):
            k = (urn[s], int(win[s]))
            if k != key:
                if key is not None:
                    done.append((key[0], key[1], _trunc_div(acc, n)))
                key, acc, n = k, 0, 0
            acc = fold(acc, val[s:e])
            n += int(e - s)
        if done:
            yield pd.DataFrame(done, columns=["urn", "timestamp", "value"])
            done = []
    if key is not None:
        yield pd.DataFrame([(key[0], key[1], _trunc_div(acc, n))], columns=["urn", "timestamp", "value"])
