"""Byte-level BPE with DuckDB recursive queries inside each Spark task.

A word is rows of (word, position, token). Every step of the recursive query
joins neighbouring tokens to the merge table and contracts the word's leftmost
pair of minimum rank, until no pair of the word is in the table. Decoding
joins ids to the vocabulary and aggregates the bytes in order of position.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokoledger.llm.common import in_arrow
from tokoledger.llm.pretokens import PooledEncoder, gathered, slices

SHORT = 64                # bytes of a word up to which one recursion runs to the fixpoint
SHORT_BATCH = 400_000     # bytes of short words in one query
LONG_ROWS = 4_000_000     # rows that a round over long words may materialise
DECODE_ROWS = 4_000_000   # tokens decoded by one query
TOGETHER = 8_000_000      # bytes of text that are encoded together

# ``key`` is the word's number and the position in one integer, so that one plain sort orders all words' rows.
_CONTRACT = """
WITH RECURSIVE state AS (
  SELECT (word::BIGINT << 32) | pos AS key, tok, false AS done FROM start
  UNION ALL (
    WITH pair AS (
      SELECT key, tok, lead(tok) OVER w AS next_tok, lead(key) OVER w AS next_key
      FROM state WHERE NOT done WINDOW w AS (ORDER BY key)),
    best AS (
      SELECT key >> 32 AS word, min((merged::BIGINT << 32) | (key & 4294967295)) AS first,
             arg_min(next_key, (merged::BIGINT << 32) | (key & 4294967295)) AS gone
      FROM pair JOIN merges ON left_tok = tok AND right_tok = next_tok WHERE key >> 32 = next_key >> 32 GROUP BY key >> 32)
    SELECT key, CASE WHEN (first & 4294967295) = (key & 4294967295) THEN (first >> 32)::INT ELSE tok END, first IS NULL
    FROM pair LEFT JOIN best ON word = key >> 32 WHERE gone IS NULL OR gone <> key)
)
SELECT (key >> 32)::INT AS word, tok FROM state WHERE done ORDER BY key
"""

# A round of at most `depth` steps over long words. Where no pair that a merge can create ranks below it
# (`safe`), all its non-overlapping occurrences are contracted in one step: the leftmost-first order would
# contract them next anyway.
_CONTRACT_LONG = """
WITH RECURSIVE state AS (
  SELECT word, pos, tok, 0 AS step FROM start
  UNION ALL (
    WITH pair AS (
      SELECT *, lead(tok) OVER w AS next_tok, row_number() OVER w AS n
      FROM state WHERE step < {depth} WINDOW w AS (PARTITION BY word ORDER BY pos)),
    ranked AS (
      SELECT word, pos, tok, step, n, merged, safe, min(merged) OVER (PARTITION BY word) AS best
      FROM pair LEFT JOIN merges ON left_tok = tok AND right_tok = next_tok),
    hit AS (SELECT *, coalesce(merged = best, false) AS hit FROM ranked WHERE best IS NOT NULL),
    run AS (
      SELECT *, min(CASE WHEN hit THEN n END) OVER (PARTITION BY word) AS leftmost,
             n - coalesce(max(CASE WHEN NOT hit THEN n END)
                          OVER (PARTITION BY word ORDER BY pos ROWS UNBOUNDED PRECEDING), 0) AS nth
      FROM hit),
    chosen AS (SELECT *, hit AND (n = leftmost OR safe AND nth % 2 = 1) AS chosen FROM run),
    kept AS (SELECT *, lag(chosen, 1, false) OVER (PARTITION BY word ORDER BY pos) AS gone FROM chosen)
    SELECT word, pos, CASE WHEN chosen THEN merged ELSE tok END, step + 1 FROM kept WHERE NOT gone)
)
SELECT word, pos, tok, step FROM state QUALIFY step = max(step) OVER (PARTITION BY word) ORDER BY word, pos
"""

_DECODE = """
SELECT from_hex(string_agg(hex, '' ORDER BY pos)) AS bytes
FROM ids JOIN vocabulary ON vocabulary.tok = ids.tok GROUP BY pos >> 14 ORDER BY pos >> 14
"""


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """Every way to join two tokens into a third, which is its own rank."""
    left, right, merged = [], [], []
    for piece, rank in ranks.items():
        for k in range(1, len(piece)):
            a, b = ranks.get(piece[:k]), ranks.get(piece[k:])
            if a is not None and b is not None:
                left.append(a), right.append(b), merged.append(rank)
    a, b, m = (np.array(x, dtype=np.int32) for x in (left, right, merged))
    unsafe = np.union1d(a[m < a], b[m < b])  # tokens of which a later, larger token ranks lower
    return pa.table({"left_tok": a, "right_tok": b, "merged": m, "safe": ~np.isin(m, unsafe)})


class Bpe:
    """Encoder and decoder of one worker."""

    def __init__(self, path: str, pattern: str):
        self.ranks = load_ranks(path)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "700MB", "temp_directory": ""})
        self.db.register("found", merge_table(self.ranks))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM found")
        self.db.unregister("found")
        vocabulary = pa.table({"tok": pa.array(self.ranks.values(), pa.int32()), "hex": [x.hex() for x in self.ranks]})
        self.db.register("found", vocabulary)
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM found")
        self.db.unregister("found")
        self.byte_tok = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        # whether a token begins with a space, and its bytes; the last one stands for ids beyond the vocabulary
        self.spaced, self.length = np.zeros((2, max(self.ranks.values()) + 2), np.int64)
        for token, rank in self.ranks.items():
            self.spaced[rank], self.length[rank] = token.startswith(b" "), len(token)
        self.encode = PooledEncoder(pattern, self.encode_words)

    def _query(self, sql: str, name: str, rows: pa.Table) -> pa.Table:
        self.db.register(name, rows)
        try:
            return self.db.sql(sql).to_arrow_table()
        finally:
            self.db.unregister(name)

    def _start(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = np.array([len(w) for w in words])
        word = np.repeat(np.arange(len(words), dtype=np.int32), n)
        pos = (np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)).astype(np.int32)
        return word, pos, self.byte_tok[np.frombuffer(b"".join(words), np.uint8)]

    def _short(self, words: list[bytes]) -> list[bytes]:
        word, pos, tok = self._start(words)
        out = self._query(_CONTRACT, "start", pa.table({"word": word, "pos": pos, "tok": tok}))
        return _by_key(out["word"].to_numpy(), out["tok"].to_numpy(), len(words))

    def _long(self, words: list[bytes]) -> list[bytes]:
        word, pos, tok = self._start(words)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(word):
            depth = int(max(1, min(64, LONG_ROWS // len(word))))
            out = self._query(_CONTRACT_LONG.format(depth=depth), "start", pa.table({"word": word, "pos": pos, "tok": tok}))
            word, pos, tok, step = (out[c].to_numpy() for c in ("word", "pos", "tok", "step"))
            over = step < depth
            done.append((word[over], tok[over]))
            word, pos, tok = word[~over], pos[~over], tok[~over]
        key, tok = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(key, kind="stable")
        return _by_key(key[order], tok[order], len(words))

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of pre-tokens, each as little-endian unsigned 32-bit bytes."""
        raw = [w.encode("utf-8", "replace") for w in words]
        out: list[bytes | None] = [None if (r := self.ranks.get(w)) is None else r.to_bytes(4, "little") for w in raw]
        rest = [i for i, x in enumerate(out) if x is None]
        for long, solve in ((False, self._short), (True, self._long)):
            mine = [i for i in rest if (len(raw[i]) > SHORT) == long]
            for part in slices(mine, lambda i: len(raw[i]), SHORT_BATCH):
                for i, ids in zip(part, solve([raw[i] for i in part]), strict=True):
                    out[i] = ids
        return out

    def _decode_runs(self, runs: pa.Array) -> pa.Array:
        """Bytes of runs of ids; ids that the vocabulary has not give none."""
        ends = _offsets(runs) // 4
        tok = np.frombuffer(runs.buffers()[2], "<u4")[ends[0]:ends[-1]]
        found = []
        for at in range(0, len(tok), DECODE_ROWS):
            part = tok[at:at + DECODE_ROWS].astype(np.int32)
            found += self._query(_DECODE, "ids", pa.table({"pos": np.arange(len(part)), "tok": part}))["bytes"].to_pylist()
        upto = np.append(0, np.cumsum(self.length[np.minimum(tok, len(self.length) - 1)]))
        offsets = np.ascontiguousarray(upto[ends - ends[0]])
        return pa.Array.from_buffers(pa.large_binary(), len(runs), [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(found))])

    def decode(self, ids: list[bytes]) -> Iterable[bytes]:
        """Bytes of whole id sequences, in their order. A sequence is cut before each token that begins with a
        space, and each distinct run of ids is decoded once."""
        for part in slices(ids, lambda x: len(x) // 4, DECODE_ROWS):
            raw = b"".join(part)
            tok = np.frombuffer(raw, "<u4")
            if not len(tok):
                yield from part
                continue
            upto = np.cumsum([len(x) // 4 for x in part])
            begins = self.spaced[np.minimum(tok, len(self.spaced) - 1)] > 0
            first = np.concatenate(([0], upto[:-1]))
            begins[first[first < upto]] = True
            begin = np.flatnonzero(begins)
            offsets = 4 * np.append(begin, len(tok)).astype(np.int64)
            runs = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
            coded = runs.dictionary_encode()
            whole = self._decode_runs(coded.dictionary).take(coded.indices)
            data = whole.buffers()[2]
            cut = _offsets(whole)[np.searchsorted(begin, np.append(first, len(tok)))].tolist()
            yield from (data[a:b].to_pybytes() for a, b in zip(cut[:-1], cut[1:]))


def _offsets(binary: pa.Array) -> np.ndarray:
    return np.frombuffer(binary.buffers()[1], np.int64)[binary.offset:][:len(binary) + 1]


def _by_key(key: np.ndarray, tok: np.ndarray, n: int) -> list[bytes]:
    raw, cut = tok.astype("<u4").tobytes(), 4 * np.searchsorted(key, np.arange(n + 1))
    return [raw[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]


_of_worker: dict[tuple, Bpe] = {}


def bpe(path: str, pattern: str) -> Bpe:
    """One per worker process, kept between tasks."""
    if (path, pattern) not in _of_worker:
        _of_worker[path, pattern] = Bpe(path, pattern)
    return _of_worker[path, pattern]


def _texts(batch, column: int) -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def _round_trip(path: str, pattern: str):
    def run(batches):
        coder = bpe(path, pattern)
        for part in gathered(batches, 1, TOGETHER):
            ids = coder.encode(_texts(part, 1))
            decoded = [hashlib.sha256(x).hexdigest() for x in coder.decode(ids)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array(decoded, pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def _encode(path: str, pattern: str):
    def run(batches):
        coder = bpe(path, pattern)
        for part in gathered(batches, 1, TOGETHER):
            ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in coder.encode(_texts(part, 1))]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return run


def _decode(path: str, pattern: str):
    def run(batches):
        coder = bpe(path, pattern)
        for batch in batches:
            ids = [np.array(x or [], "<u4").tobytes() for x in batch.column(1).to_pylist()]
            texts = [x.decode("utf-8", "replace") for x in coder.decode(ids)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return run


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def bpe_encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, ids)``: the ids of every whole text, without special tokens. A null
    or empty text has no ids. Rows without a doc_id and repeated rows are encoded
    like any other; further columns are not read."""
    return in_arrow(_input(docs), _encode(path, pattern), "doc_id long, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, ids)`` -> ``(doc_id, text)``; null ids give an empty text, bytes that
    are not UTF-8 become U+FFFD."""
    rows = encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>"))
    return in_arrow(rows, _decode(path, pattern), "doc_id long, text string")


def bpe_round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256 (of the ids as
    little-endian unsigned 32-bit integers) and decoded_sha256 (of the bytes that
    the ids decode to). Null text counts as empty; see ``bpe_encode``."""
    return in_arrow(
        _input(docs), _round_trip(path, pattern), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
