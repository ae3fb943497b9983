"""Packing documents into training sequences by Karmarkar-Karp differencing.

Each task tokenizes its documents and cuts them: every full window of a
document is a sequence of its own, the rest is cut into pieces of at most a
quarter window. The pieces are gathered until they fill a fixed number of
windows but for a small slack, and multiway differencing deals them to
the windows: two partial partitions are merged so that the fullest windows of
one meet the emptiest of the other, always for the two partitions with the
largest imbalance. If a window comes out over capacity, the same pieces are
dealt to one window more. No row leaves its task, so nothing is shuffled.
"""

from __future__ import annotations

import heapq
import math
import re
import sys
import zlib
from array import array
from itertools import islice, repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tokoledger.llm.common import in_arrow, of_worker
from tokoledger.llm.pretokens import KEPT, SLICE, CachedEncoder, chunks, runs, uneven_spaces

WINDOWS = 128     # windows that one differencing run fills
SPACE = "\u0120"  # how a byte-level vocabulary spells a space
SLACK = 16        # tokens a window that are left free, so that near-equal windows stay within capacity


def difference(sizes: list[int], windows: int) -> list[tuple[int, tuple[int, ...]]]:
    """Karmarkar-Karp: (sum, item numbers) of each non-empty window, at most ``windows``."""
    heap = [(-s, i, [(s, (i,))]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    made = len(sizes)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        if len(a) + len(b) <= windows:
            merged = a + b
        else:
            wide = a + [(0, ())] * (windows - len(a))
            opposed = [(0, ())] * (windows - len(b)) + b[::-1]
            merged = [(x + y, i + j) for (x, i), (y, j) in zip(wide, opposed, strict=True)]
        merged.sort(key=itemgetter(0), reverse=True)      # stable, as without reverse
        imbalance = merged[0][0] - (merged[-1][0] if len(merged) == windows else 0)
        made += 1
        heapq.heappush(heap, (-imbalance, made, merged))
    return heap[0][2] if heap else []


def windows_of(sizes: list[int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """As few near-equal windows as the capacity allows; a size is at most the capacity."""
    windows = max(1, math.ceil(sum(sizes) / capacity))
    while True:
        found = difference(sizes, windows)
        if not found or max(s for s, _ in found) <= capacity:
            return found
        windows += 1


def _little(ids: array) -> array:
    if sys.byteorder == "big":
        ids.byteswap()
    return ids


class _Encoder:
    """Texts -> ids as the tokenizer gives them, with the end id behind each text.

    A text is cut before each space that is followed by a visible character, which no pre-token crosses. The distinct
    chunks of many texts are found at once and encoded joined to one string: a chunk without a further space is cut out
    again at the tokens that begin with a space. The ids of a chunk lie in a slot of ``pool``, and texts are gathered from
    slots. The strings of added tokens are one id each, wherever they stand.
    """

    def __init__(self, path: str, pattern: str, remembered: int, end_id: int):
        self.tokenizer = tokenizer = Tokenizer.from_file(path)
        added = {x.content: n for n, x in tokenizer.get_added_tokens_decoder().items()}
        self.added = {text: n.to_bytes(4, "little") for text, n in added.items()}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")").split if added else None
        vocabulary = tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.spaced[[n for text, n in vocabulary.items() if text.startswith(SPACE)]] = True

        def encode_words(words: list[str]) -> list[bytes]:
            out = []
            for at in range(0, len(words), 50_000):
                for x in tokenizer.encode_batch_fast(words[at:at + 50_000], add_special_tokens=False):
                    out.append(_little(array("I", x.ids)).tobytes())
            return out

        self.plain = CachedEncoder(pattern, encode_words, remembered)
        self.kept = 2 * remembered      # the other half of what the words and chunks of ``plain`` may take
        self.slots: dict[str, int] = {}
        # slot 0 is the end id
        self.pool, self.ends = np.array([end_id], "<u4"), np.array([0, 1])

    def _whole(self, texts: list[str]) -> list[bytes]:
        """Texts that may hold added tokens."""
        if not any(x in t for x in self.added for t in texts):
            return self.plain(texts)
        parts = [self.split(t) for t in texts]
        ids = iter(self.plain([p for ps in parts for p in ps[::2]]))
        return [b"".join(self.added[p] if k % 2 else next(ids) for k, p in enumerate(ps)) for ps in parts]

    def _joined(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks with their space, one after the other, and how many each has."""
        x = self.tokenizer.encode_batch_fast([" " + " ".join(chunks)], add_special_tokens=False)[0]
        ids = np.array(x.ids, "<u4")
        at = np.flatnonzero(self.spaced[ids])
        if len(at) == len(chunks) and at[0] == 0:
            return ids, np.diff(at, append=len(ids))
        return _flat(self.plain([" " + c for c in chunks]))       # not a byte-level vocabulary

    def _encode(self, chunks: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """The chunks in the order of their ids and their positions, the ids and how many each has."""
        further = [i for i, c in enumerate(chunks) if " " in c]
        place = np.delete(np.arange(len(chunks)), further)
        lone = [chunks[i] for i in place.tolist()] if further else chunks
        found = [self._joined(lone[at:at + 50_000]) for at in range(0, len(lone), 50_000)]
        if further:
            rest = [chunks[i] for i in further]
            found.append(_flat(self.plain([" " + c for c in rest])))
            lone, place = lone + rest, np.concatenate([place, further])
        return lone, place, *(np.concatenate(x) for x in zip(*found))

    def _append(self, pool: np.ndarray, ends: np.ndarray, ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([pool, ids]), np.concatenate([ends, ends[-1] + np.cumsum(n)])

    def _slots_of(self, chunks: pa.Array) -> np.ndarray:
        """Slot of each chunk; new ones are appended."""
        if not len(chunks):
            return np.zeros(0, np.int64)
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        slot = np.fromiter(map(self.slots.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(slot < 0)
        if len(new):
            fresh, place, ids, n = self._encode([distinct[i] for i in new.tolist()])
            first = len(self.ends) - 1
            self.pool, self.ends = self._append(self.pool, self.ends, ids, n)
            self.slots.update(zip(fresh, range(first, first + len(fresh))))
            slot[new[place]] = np.arange(first, first + len(fresh))
        return slot[coded.indices.to_numpy()]

    def _forget(self) -> None:
        """Forget what came last where more than ``kept`` chunks are remembered."""
        if len(self.slots) > self.kept:
            for chunk in list(islice(reversed(self.slots), len(self.slots) - self.kept)):
                del self.slots[chunk]
            self.ends = self.ends[:self.kept + 2].copy()
            self.pool = self.pool[:self.ends[-1]].copy()

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text ends; a null text counts as empty."""
        texts = [t or "" for t in column.to_pylist()]
        whole = [k for k, t in enumerate(texts) if any(x in t for x in self.added)]
        for k in whole:
            texts[k] = ""
        uneven = [k for k, t in enumerate(texts) if uneven_spaces(t)]
        cut = [chunks(texts[k]) for k in uneven]
        for k in uneven:
            texts[k] = ""
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        at, values = lists.offsets.to_numpy(), lists.values
        inner = np.ones(len(values), bool)
        inner[at[:-1]] = False                       # first chunks have no space before them
        inner = values.filter(pa.array(inner))
        heads = values.take(pa.array(at[:-1])).to_pylist()
        n = np.diff(at) - 1
        for k, c in zip(uneven, cut):
            heads[k] = c[0]
        if uneven:
            inner = pa.concat_arrays([inner, pa.array([x for c in cut for x in c[1:]], pa.large_string())])
        slot = self._slots_of(inner)

        # the slots of each text: its first chunk (or the whole text with added tokens), its other chunks, the end id
        first = self.plain(heads)
        for k, ids in zip(whole, self._whole([column[k].as_py() for k in whole]), strict=True):
            first[k] = ids
        head = len(self.ends) - 1 + np.arange(len(texts))
        pool, ends = self._append(self.pool, self.ends, *_flat(first))
        even = n.copy()
        for k, c in zip(uneven, cut):
            n[k] = len(c) - 1
        upto = np.cumsum(n + 2)
        order = np.zeros(upto[-1], np.int64)         # 0: the end id
        order[upto - n - 2] = head
        rest = np.ones(len(order), bool)
        rest[upto - n - 2] = rest[upto - 1] = False
        late = np.repeat(n != even, n) if uneven else np.zeros(int(n.sum()), bool)
        at = np.flatnonzero(rest)
        order[np.concatenate([at[~late], at[late]])] = slot
        lengths = ends[order + 1] - ends[order]
        done = np.cumsum(lengths)
        ids = pool[np.repeat(ends[order] - (done - lengths), lengths) + np.arange(done[-1])]
        self._forget()
        return ids, done[upto - 1]


def _flat(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(ids), "<u4"), np.array([len(x) // 4 for x in ids], np.int64)


def _encoder(path: str, pattern: str, remembered: int, end_id: int) -> _Encoder:
    key = path, pattern, remembered, end_id
    return of_worker(__name__, key, lambda: _Encoder(*key))


COLUMNS = {
    "doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(),
    "doc_tokens": pa.int64(), "sequence_id": pa.int64(), "offset": pa.int64(),
}


def _pack(path: str, pattern: str, capacity: int, end_id: int, remembered: int, together: int):
    def run(batches):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        encode = _encoder(path, pattern, remembered, end_id)
        piece_most = max(1, capacity // 4)
        aim = WINDOWS * (capacity - min(SLACK, capacity // 64))
        sequence = TaskContext.get().partitionId() << 32
        out: list[tuple] = []
        waiting: list[tuple] = []   # doc_id, start, length, crc, doc_tokens
        held = 0

        def flush():
            nonlocal sequence, waiting, held
            for _, members in windows_of([p[2] for p in waiting], capacity):
                offset = 0
                for m in members:
                    out.append((*waiting[m], sequence, offset))
                    offset += waiting[m][2]
                sequence += 1
            waiting, held = [], 0

        def batch_of(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), COLUMNS.values(), strict=True)], list(COLUMNS)
            )

        for part in (part for batch in batches for part in runs(batch, 1, together)):
            encoded, ends = encode(part.column(1))
            encoded, begin = memoryview(encoded).cast("B"), 0
            for doc_id, end in zip(part.column(0).to_pylist(), ends.tolist(), strict=True):
                ids, total, start = encoded[4 * begin:4 * end], end - begin, 0
                begin = end
                while total - start >= capacity:
                    crc = zlib.crc32(ids[4 * start:4 * (start + capacity)])
                    out.append((doc_id, start, capacity, crc, total, sequence, 0))
                    sequence += 1
                    start += capacity
                while start < total:
                    length = min(piece_most, total - start, aim - held)
                    waiting.append((doc_id, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), total))
                    start += length
                    held += length
                    if held == aim:
                        flush()
            if out:
                yield batch_of(out)
                out = []
        flush()
        if out:
            yield batch_of(out)

    return run


def pack(docs: DataFrame, path: str, pattern: str, capacity: int = 1024, end_id: int = 0, remembered: int = KEPT, together: int = SLICE) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset. A document's tokens are those of its whole text and
    ``end_id``; a null or empty text has the end id alone. Each token lies in
    one piece, and the pieces of a sequence lie gapless from offset 0.

    Rows without a doc_id and repeated rows are packed like any other (the
    repeated row's pieces come again). An empty table has no pieces. Strings of
    added tokens in a text are one id each, as the tokenizer gives them. Further columns are not read.
    ``remembered`` words are kept by each worker to save time, and ``together`` bytes
    of text are encoded at once; neither changes a row.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return in_arrow(
        rows, _pack(path, pattern, capacity, end_id, remembered, together),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
