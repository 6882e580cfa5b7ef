"""Token ids of texts from the remembered ids of their chunks."""

from __future__ import annotations

import contextlib
import gc
import itertools
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

CHUNKS_KEPT = 400_000
SPREAD = 1 << 16  # chunks whose ids are gathered together


class _Ordinals(dict):
    """Numbers its keys in the order in which they are first asked for; ``fresh`` lists new ones."""

    def __init__(self):
        self.fresh = []

    def __missing__(self, key):
        number = self[key] = len(self)
        self.fresh.append(key)
        return number


@contextlib.contextmanager
def _uncollected() -> Iterator[None]:
    """Without searches for reference cycles: none are made here, and tables of a million entries
    would be walked again and again."""
    running = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if running:
            gc.enable()


class ChunkCache:
    """``encode`` gets chunks not seen before and gives the ids of each, or as arrays the ids of all, where
    each chunk's begin, and how many they are.

    A text is a list of chunks; its ids are those of its chunks, one after the other.  The memory is
    bounded: when more than ``limit`` chunks are known, those met once are forgotten, and all but the
    more frequent half of ``limit``.
    """

    def __init__(
        self, encode: Callable[[list], list[Sequence[int]] | tuple[np.ndarray, np.ndarray, np.ndarray]],
        limit: int = CHUNKS_KEPT,
    ):
        self.encode, self.limit = encode, limit
        self.ordinals = _Ordinals()
        self.uses = np.zeros(1 << 12, np.int64)
        self.starts = np.zeros(1 << 12, np.int64)
        self.sizes = np.zeros(1 << 12, np.int64)
        self.flat = np.zeros(1 << 14, np.uint32)
        self.known = self.used = 0

    def _forget(self) -> None:
        uses = self.uses[: self.known]
        keep = np.flatnonzero(uses > 1)
        if 2 * len(keep) > self.limit:
            keep = np.sort(keep[np.argsort(-uses[keep], kind="stable")[: self.limit // 2]])
        chunks = list(self.ordinals)
        self.ordinals = _Ordinals()
        self.ordinals.update((chunks[k], i) for i, k in enumerate(keep.tolist()))
        sizes, starts = self.sizes[keep], self.starts[keep]
        self.flat = self.flat[spans(starts, sizes)]
        self.known, self.used = len(keep), len(self.flat)
        self.sizes, self.uses = sizes, np.ones(len(keep), np.int64)
        self.starts = np.cumsum(sizes) - sizes

    def _learn(self) -> None:
        fresh, self.ordinals.fresh = self.ordinals.fresh, []
        if not fresh:
            return
        found = self.encode(fresh)
        if isinstance(found, tuple):
            ids, starts, sizes = found
        else:
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            ids = np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(sizes.sum()))
            starts = np.cumsum(sizes) - sizes
        self.uses = _room(self.uses, self.known + len(fresh))
        self.starts = _room(self.starts, self.known + len(fresh))
        self.sizes = _room(self.sizes, self.known + len(fresh))
        self.flat = _room(self.flat, self.used + len(ids))
        here = slice(self.known, self.known + len(fresh))
        self.sizes[here] = sizes
        self.starts[here] = self.used + starts
        self.flat[self.used : self.used + len(ids)] = ids
        self.known += len(fresh)
        self.used += len(ids)

    def ids(self, texts: list[list]) -> list[np.ndarray]:
        if self.known > self.limit:
            self._forget()
        number = self.ordinals.__getitem__
        with _uncollected():
            chunks = [np.fromiter(map(number, text), np.int64, len(text)) for text in texts]
            self._learn()
        out = []
        for numbers in chunks:
            np.add.at(self.uses, numbers, 1)
            out.append(self.flat[spans(self.starts[numbers], self.sizes[numbers])])
        return out


    def ids_of(self, texts: pa.ListArray) -> list[np.ndarray]:
        """As :meth:`ids`, for lists of chunks (texts or bytes, looked up as bytes) in an Arrow array: each
        distinct chunk of the array is looked up once."""
        if self.known > self.limit:
            self._forget()
        coded = texts.flatten().dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary()).to_pylist()
        with _uncollected():
            numbers = np.fromiter(map(self.ordinals.__getitem__, distinct), np.int64, len(distinct))
            self._learn()
        del distinct
        at = coded.indices.to_numpy(zero_copy_only=False)
        self.uses[numbers] += np.bincount(at, minlength=len(numbers))
        starts, sizes = self.starts[numbers], self.sizes[numbers]
        offsets = texts.offsets.to_numpy()
        offsets = offsets - offsets[0]
        out, low = [], 0
        while low < len(texts):  # some texts at a time: the places of all their ids are held at once
            high = int(np.searchsorted(offsets, offsets[low] + SPREAD, side="right")) - 1
            high = max(high, low + 1)
            each = at[offsets[low] : offsets[high]]
            many = sizes[each]
            flat = self.flat[spans(starts[each], many)]
            ends = np.concatenate([[0], np.cumsum(many)])
            cuts = ends[offsets[low : high + 1] - offsets[low]].tolist()
            out += [flat[a:b] for a, b in zip(cuts, cuts[1:])]
            low = high
        return out


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all given spans, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(total)


def _room(values: np.ndarray, size: int) -> np.ndarray:
    if size <= len(values):
        return values
    grown = np.zeros(max(size, 2 * len(values)), values.dtype)
    grown[: len(values)] = values
    return grown
