"""Texts as runs of bytes that a tokenizer treats alone, and what it made of them.

Text repeats. A tokenizer's ids are therefore found once for each distinct
*unit*: a run of bytes between two places that no token can span. ``cut``
finds the units of a batch as slices of one buffer (no copy), Arrow's
dictionary encoding names the distinct ones, and ``Entries`` keeps the ids of
those that a worker has met, in flat arrays that whole batches are gathered from.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_REMEMBERED = 600_000     # units that a worker remembers before it starts anew


def filled(texts: pa.Array) -> pa.Array:
    """Texts with null as empty, in one array that starts at its first byte."""
    texts = pc.fill_null(texts, "")
    return pa.concat_arrays([texts]) if texts.offset == 0 else pa.concat_arrays([texts.take(pa.array(np.arange(len(texts))))])


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts (no nulls), and where each begins and the last ends."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[ends[0]:ends[-1]], ends - ends[0]


def space_led(texts: pa.Array) -> pa.Array:
    """A space before each text that is not empty."""
    return pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(pa.scalar(""), texts, pa.scalar(" ")))


def distinct_units(buf: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Number of each unit's entry in the list of distinct units, and that list."""
    offsets = np.append(begin, len(buf)).astype(np.int32)
    units = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(buf))])
    coded = units.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist()


def cut(buf: np.ndarray, ends: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the units begin, and how many each text has: texts are cut at
    ``cuts`` (ascending places in the buffer) and at their own edges."""
    edge = np.zeros(len(buf) + 1, bool)
    edge[cuts] = True
    edge[ends] = True                        # edges between texts; empty texts share one
    begin = np.flatnonzero(edge[:-1])
    return begin, np.diff(np.searchsorted(begin, ends))


def gather(pool: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices ``pool[begin:begin + size]``, one after another."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(begin - (ends - size), size) + np.arange(total)]


Learned = tuple[list[bytes], np.ndarray, np.ndarray]


class Entries:
    """Ids of the units met so far. ``learn(units)`` finds those of new ones: the
    units in an order of its own, all their ids, and how many each has."""

    def __init__(self, learn: Callable[[list[bytes]], Learned], most: int = _REMEMBERED):
        self.learn, self.most = learn, most
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.pool, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def ids(self, buf: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units in order, and how many each unit has."""
        if not len(begin):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        if len(self.number) > self.most:
            self.clear()
        code, units = distinct_units(buf, begin)
        number = self.number
        new = [u for u in units if u not in number]
        if new:
            new, found, sizes = self.learn(new)
            number.update(zip(new, range(len(number), len(number) + len(new))))
            self.pool = np.concatenate([self.pool, found.astype(np.int32, copy=False)])
            self.size = np.concatenate([self.size, sizes])
            self.start = np.cumsum(self.size) - self.size
        entry = np.fromiter(map(number.__getitem__, units), np.int64, len(units))[code]
        size = self.size[entry]
        return gather(self.pool, self.start[entry], size), size


def flat(units: list[bytes], found: list[list[int]]) -> Learned:
    return (units, np.array([i for ids in found for i in ids], np.int32), np.fromiter(map(len, found), np.int64, len(found)))


def per_text(size: np.ndarray, units: np.ndarray) -> np.ndarray:
    """Ids of each text, from the ids of each unit and the units of each text."""
    total = np.concatenate([[0], np.cumsum(size)])
    ends = np.cumsum(units)
    return total[ends] - total[ends - units]
