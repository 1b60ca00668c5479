"""Slices of Arrow batches by the size of their texts, so that what a task makes of one stays small."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
TEXT_BYTES = 1 << 20  # of texts that become Python strings together


def release() -> None:
    """Free memory of this Python worker goes back to the system.

    Workers live on between tasks and stages; what their allocators keep would add up over a pipeline.
    """
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()  # the one that Python's and numpy's large objects come from


def by_size(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows whose values of ``column`` take about ``size`` bytes together, or one longer row.

    They are copies, so that no batch is held beyond its last slice.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        length = pc.fill_null(pc.cast(pc.binary_length(batch.column(column)), pa.int64()), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(length) // size
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.take(np.arange(start, end))
        del batch
        release()
    release()  # once the source has let go of its last batch


def mapped(texts: pa.Array, function: Callable, kind: pa.DataType) -> pa.Array:
    """``function`` of each text or null; of a long column only a slice at a time is Python strings."""
    slices = by_size(iter([pa.RecordBatch.from_arrays([texts], names=["text"])]), size=TEXT_BYTES)
    found = [pa.array([function(t) for t in part.column("text").to_pylist()], kind) for part in slices]
    return pa.concat_arrays(found) if found else pa.array([], kind)


def ragged(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """``values`` cut into lists of the given lengths."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def gather(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``pool`` that begin at ``starts``, one after another."""
    ends = np.cumsum(sizes)
    return pool[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
