"""Summaries of the pairwise running average ``acc <- (acc + v) / 2``.

A chunk of ``k`` readings in a row turns ``acc`` into ``acc / 2**k + c``; a fold that begins with the chunk
gives ``first / 2**k + c``. So ``(first, k, c)`` says all about a chunk, and chunks that follow each other merge:

    (f1, k1, c1) then (f2, k2, c2)  =  (f1, k1 + k2, c1 / 2**k2 + c2)

:func:`summarise` runs over sorted Arrow batches (``mapInArrow``) and holds one batch and one open chunk.
The module depends on numpy and pyarrow only and is shipped by value, so executors need no install.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# below this exponent a weight is the smallest double, not 0: an infinite reading stays infinite
LEAST_EXPONENT = -1074


def weights(k: np.ndarray) -> np.ndarray:
    return np.ldexp(1.0, np.maximum(-np.asarray(k, np.int64), LEAST_EXPONENT).astype(np.int32))


def segments(batch: pa.RecordBatch, n_keys: int) -> np.ndarray:
    """Starts of the runs of equal keys."""
    new = np.zeros(batch.num_rows, bool)
    new[0] = True
    for i in range(n_keys):
        col = batch.column(i)
        new[1:] |= pc.fill_null(pc.not_equal(col[1:], col[:-1]), True).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def summarise(batches: Iterable[pa.RecordBatch], n_keys: int, part: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows (keys..., value, timestamp) to chunks (keys..., part, first, k, c, first_ts), one per key and task.

    ``first_ts`` is the earliest timestamp of the chunk. Rows without a value must be gone."""
    names = None
    open_: list | None = None  # keys, first, k, c, first_ts of the chunk that the next batch may continue

    def rows(items):
        cols = list(zip(*[(*keys, part, first, k, c, ts) for keys, first, k, c, ts in items]))
        kinds = [*key_types, pa.int32(), pa.float64(), pa.int64(), pa.float64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        if names is None:
            names = [*batch.schema.names[:n_keys], "part", "first", "k", "c", "first_ts"]
            key_types = [batch.schema.field(i).type for i in range(n_keys)]
        start = segments(batch, n_keys)
        value = batch.column(n_keys).to_numpy(zero_copy_only=False)
        ts = np.asarray(pc.fill_null(batch.column(n_keys + 1), np.iinfo(np.int64).max))
        size = np.diff(np.append(start, batch.num_rows))
        to_end = np.repeat(start + size, size) - np.arange(batch.num_rows)  # 1 at a chunk's last reading
        c = np.add.reduceat(value * weights(to_end), start)
        earliest = np.minimum.reduceat(ts, start)
        keys = list(zip(*[batch.column(i).take(pa.array(start)).to_pylist() for i in range(n_keys)]))
        found = [list(x) for x in zip(keys, value[start].tolist(), size.tolist(), c.tolist(), earliest.tolist())]
        if open_ is not None:
            if open_[0] == found[0][0]:
                _, _, k2, c2, ts2 = found[0]
                found[0] = [open_[0], open_[1], open_[2] + k2, open_[3] * float(weights(k2)) + c2, min(open_[4], ts2)]
            else:
                found.insert(0, open_)
        open_ = found.pop()
        if found:
            yield rows(found)
    if open_ is not None:
        yield rows([open_])
