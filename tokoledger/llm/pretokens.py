"""Whole texts to token ids through distinct words.

A text is cut before each space that is followed by a visible character; no
pre-token of the byte-level pattern crosses such a place, so each chunk can be
encoded on its own and a worker encodes each distinct chunk once. The caches
are bounded; what does not fit is encoded again when it comes again.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

KEPT = 300_000                      # words, and as many chunks, that a worker remembers
SLICE = 4_000_000                   # characters of text that are encoded together
_INNER = re.compile(r" (?=\S)")     # re's \S is no wider than the pattern's, so this never cuts inside a pre-token
_SPACE_BEFORE_SPACE = re.compile(r" (?!\S)")


def uneven_spaces(text: str) -> bool:
    """Whether a space is followed by another blank or by nothing, so that not every space begins a chunk."""
    return _SPACE_BEFORE_SPACE.search(text) is not None


def chunks(text: str) -> list[str]:
    """The first chunk, then the others without their leading space."""
    return _INNER.split(text) if uneven_spaces(text) else text.split(" ")


def slices(rows: Iterable, size: Callable, most: int = SLICE) -> Iterator[list]:
    """Rows in runs of about ``most`` characters, one row at least."""
    part, held = [], 0
    for row in rows:
        part.append(row)
        held += size(row)
        if held >= most:
            yield part
            part, held = [], 0
    if part:
        yield part


def runs(batch, column: int, most: int = SLICE) -> Iterator:
    """Consecutive parts of an Arrow batch with about ``most`` bytes of text each, one row
    at least; only a part at a time becomes Python strings."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(at, upto - at)
        at = upto


def gathered(batches: Iterable, column: int, most: int = SLICE) -> Iterator:
    """Arrow batches joined and cut to ones with about ``most`` bytes of text each, one row at least."""
    held, size = [], 0
    for part in (part for batch in batches for part in runs(batch, column, most)):
        held.append(part)
        size += pc.sum(pc.binary_length(part.column(column))).as_py() or 0
        if size >= most:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


class CachedEncoder:
    """``encode_words``: pre-tokens -> their ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, pattern: str, encode_words: Callable[[list[str]], list[bytes]], kept: int = KEPT):
        self.find, self.encode_words, self.kept = regex.compile(pattern).findall, encode_words, kept
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def _split(self, chunk: str) -> list[str]:
        """Pre-tokens of a chunk with its space; letters, with one mark behind them or not, need no pattern."""
        if chunk.isalpha():
            return [" " + chunk]
        if chunk[-1] in ".," and chunk[:-1].isalpha():
            return [" " + chunk[:-1], chunk[-1]]
        return self.find(" " + chunk)

    def _trim(self, cache: dict, new: dict, kept: int) -> None:
        """Forget what came last where the cache is full."""
        if len(cache) > kept:
            for key in new:
                del cache[key]

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [chunks(t) for t in texts]
        first = [self.find(c[0]) for c in split]
        for c in split:
            del c[0]
        missing = list(set().union(*split).difference(self.chunks))
        found = list(map(self._split, missing))
        new = list(set().union(*found, *first).difference(self.words))
        words = dict(zip(new, self.encode_words(new), strict=True))
        self.words.update(words)
        join, word = b"".join, self.words.__getitem__
        fresh = {c: word(ws[0]) if len(ws) == 1 else join(map(word, ws)) for c, ws in zip(missing, found, strict=True)}
        self.chunks.update(fresh)
        chunk = self.chunks.__getitem__
        out = [join(map(word, f)) + join(map(chunk, c)) for f, c in zip(first, split, strict=True)]
        self._trim(self.words, words, self.kept)
        self._trim(self.chunks, fresh, self.kept)
        return out


class PooledEncoder(CachedEncoder):
    """As ``CachedEncoder``, for many texts at once: Arrow finds their distinct chunks, the ids of a chunk lie in a
    slot of ``pool``, and numpy gathers the texts from the slots."""

    def __init__(self, pattern: str, encode_words: Callable[[list[str]], list[bytes]], kept: int = KEPT):
        super().__init__(pattern, encode_words, kept)
        self.slots: dict[str, int] = {}
        self.pool, self.ends = np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def _ids(self, found: list[list[str]]) -> list[bytes]:
        """Ids of lists of pre-tokens."""
        new = list(set().union(*found).difference(self.words))
        words = dict(zip(new, self.encode_words(new), strict=True))
        self.words.update(words)
        join, word = b"".join, self.words.__getitem__
        out = [word(ws[0]) if len(ws) == 1 else join(map(word, ws)) for ws in found]
        self._trim(self.words, words, self.kept)
        return out

    def _appended(self, ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        return np.concatenate([self.pool, np.frombuffer(b"".join(ids), "<u4")]), np.concatenate([self.ends, self.ends[-1] + np.cumsum(n)])

    def _slots_of(self, chunks: pa.Array) -> np.ndarray:
        """Slot of each chunk; new ones are appended."""
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        slot = np.fromiter(map(self.slots.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(slot < 0)
        if len(new):
            fresh = [distinct[i] for i in new.tolist()]
            slot[new] = np.arange(len(new)) + len(self.ends) - 1
            self.slots.update(zip(fresh, slot[new].tolist(), strict=True))
            self.pool, self.ends = self._appended(self._ids(list(map(self._split, fresh))))
        return slot[coded.indices.to_numpy()]

    def _forget(self) -> None:
        """Forget what came last where more than twice ``kept`` chunks are remembered."""
        most = 2 * self.kept
        if len(self.slots) > most:
            for chunk in list(islice(reversed(self.slots), len(self.slots) - most)):
                del self.slots[chunk]
            self.ends = self.ends[:most + 1].copy()
            self.pool = self.pool[:self.ends[-1]].copy()

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        uneven = [k for k, t in enumerate(texts) if uneven_spaces(t)]
        cut = [chunks(texts[k]) for k in uneven]
        even = np.delete(np.arange(len(texts)), uneven).tolist()
        lists = pc.split_pattern(pa.array([texts[k] for k in even], pa.large_string()), " ")
        at, values = lists.offsets.to_numpy(), lists.values
        inner = np.ones(len(values), bool)
        inner[at[:-1]] = False                       # first chunks have no space before them
        inner = pa.concat_arrays([values.filter(pa.array(inner)), pa.array([x for c in cut for x in c[1:]], pa.large_string())])
        heads = values.take(pa.array(at[:-1])).to_pylist() + [c[0] for c in cut]
        n = np.concatenate([np.diff(at), [len(c) for c in cut]]).astype(np.int64)
        slot = self._slots_of(inner)

        # the slots of each text: its first chunk, then the others
        pool, ends = self._appended(self._ids(list(map(self.find, heads))))
        upto = np.cumsum(n)
        rest = np.ones(upto[-1], bool)
        rest[upto - n] = False
        order = np.empty(upto[-1], np.int64)
        order[~rest] = len(self.ends) - 1 + np.arange(len(texts))
        order[rest] = slot
        begin = ends[order]
        lengths = ends[order + 1] - begin
        done = np.cumsum(lengths)
        ids = pool[np.repeat(begin - (done - lengths), lengths) + np.arange(done[-1])].tobytes()
        self._forget()
        stops = (4 * done[upto - 1]).tolist()
        out = [b""] * len(texts)
        for k, a, b in zip(even + uneven, [0] + stops, stops):
            out[k] = ids[a:b]
        return out
