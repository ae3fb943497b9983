"""Fill-in-middle transformation of whole texts, cut at unit ends.

A unit is a run of ASCII letters or any other single code point. The cuts are found
without walking the text: its UTF-8 bytes are read as 64-bit words, and word arithmetic
marks each byte that ends a unit with its top bit. ``bitwise_count`` per word and a running
sum give the rank of a word; the word with the k-th end is found by search in the
running sum, and the end inside the word by clearing the lower marks.

The texts of a batch lie behind each other in one buffer, so the words cover many
texts at once; the last byte of a text ends a unit whatever follows.

Null text counts as ''. A text that is empty or holds a sentinel stays plain, as do the
share that the hash leaves out. A null id hashes as the empty string. Rows repeat as often as
they are given; an empty table gives no rows. All columns of the input stay, except
those with the names of the new ones, which are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokoledger.llm.common import in_arrow
from tokoledger.llm.pretokens import runs

SENTINELS = ("<P>", "<S>", "<M>")      # prefix, suffix, middle
TOGETHER = 4_000_000                   # bytes of text that are marked together
WORDS = 1 << 16                        # words that are marked at once

_TOP = np.uint64(0x8080808080808080)
_SEVEN = np.uint64(0x7F7F7F7F7F7F7F7F)
_CASE = np.uint64(0x2020202020202020)
_FROM_A = np.uint64((0x80 - ord("a")) * 0x0101010101010101)
_PAST_Z = np.uint64((0x80 - ord("z") - 1) * 0x0101010101010101)
_ONE, _BYTE, _REST = np.uint64(1), np.uint64(8), np.uint64(56)


def _letters(w: np.ndarray) -> np.ndarray:
    """Top bit of each byte that is an ASCII letter."""
    low = w & _SEVEN | _CASE
    return low + _FROM_A & ~(low + _PAST_Z) & ~w & _TOP


def _inside(w: np.ndarray) -> np.ndarray:
    """Top bit of each byte that goes on with a code point (10xxxxxx)."""
    return w & ~(w << _ONE) & _TOP


class Units:
    """Marks over ``data``, the UTF-8 of texts behind each other that end before the bytes ``stops``."""

    def __init__(self, data: np.ndarray, stops: np.ndarray):
        padded = np.zeros(-(-(len(data) + 1) // 8) * 8, np.uint8)
        padded[: len(data)] = data
        words = padded.view("<u8")
        self.ends = np.empty(len(words), np.uint64)
        self.points = np.empty(len(words), np.uint64)
        for lo in range(0, len(words), WORDS):
            w = words[lo : lo + WORDS + 1]
            letter, inside = _letters(w), _inside(w)
            n = min(WORDS, len(words) - lo)
            following = lambda m: (m[:n] >> _BYTE) | np.append(m[1 : n + 1], np.zeros(n + 1 - len(m[: n + 1]), np.uint64)) << _REST
            self.ends[lo : lo + n] = _TOP & ~(following(inside) | letter[:n] & following(letter))
            self.points[lo : lo + n] = _TOP & ~inside[:n]
        last = stops[stops > 0] - 1
        np.bitwise_or.at(self.ends, last >> 3, np.uint64(0x80) << ((last & 7) * 8).astype(np.uint64))
        self.n_ends = np.cumsum(np.bitwise_count(self.ends), dtype=np.int64)
        self.n_points = np.cumsum(np.bitwise_count(self.points), dtype=np.int64)

    @staticmethod
    def _rank(marks: np.ndarray, sums: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Marks before byte ``at``."""
        word = at >> 3
        below = (_ONE << ((at & 7) * 8).astype(np.uint64)) - _ONE
        return sums[word] - np.bitwise_count(marks[word]).astype(np.int64) + np.bitwise_count(marks[word] & below)

    def ends_before(self, at: np.ndarray) -> np.ndarray:
        return self._rank(self.ends, self.n_ends, at)

    def points_before(self, at: np.ndarray) -> np.ndarray:
        return self._rank(self.points, self.n_points, at)

    def after_end(self, k: np.ndarray) -> np.ndarray:
        """Byte behind the k-th end of the buffer, k from 1."""
        word = np.searchsorted(self.n_ends, k, side="left")
        marks = self.ends[word]
        skip = k - (self.n_ends[word] - np.bitwise_count(marks)) - 1
        for step in range(7):
            marks = np.where(skip > step, marks & (marks - _ONE), marks)
        lowest = marks & (~marks + _ONE)
        return word * 8 + (np.bitwise_count(lowest - _ONE).astype(np.int64) >> 3) + 1


def _draws(seed: int, doc_id) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def _texts(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow text column and the offsets of its texts (null: empty)."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _transform(ids: list, column, seed: int, percent: int, spm_percent: int):
    """Per text: units, form, code points of prefix and middle, output."""
    data, offsets = _texts(column)
    starts, stops = offsets[:-1], offsets[1:]
    units = Units(data, stops[stops > starts])
    before = units.ends_before(starts)
    n = np.where(stops > starts, units.ends_before(stops) - before, 0)
    h = np.array([_draws(seed, i) for i in ids], np.int64).reshape(-1, 4)
    cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    at = np.where(cuts > 0, units.after_end(np.maximum(before[:, None] + cuts, 1)), starts[:, None]) if len(data) else np.zeros((len(n), 2), np.int64)
    points = units.points_before(np.column_stack((starts, at)))
    p, s, m = (x.encode() for x in SENTINELS)
    rows = []
    for k, (lo, a, b, hi) in enumerate(zip(starts.tolist(), at[:, 0].tolist(), at[:, 1].tolist(), stops.tolist(), strict=True)):
        text = data[lo:hi].tobytes()
        if lo == hi or h[k, 2] % 100 >= percent or p in text or s in text or m in text:
            rows.append(("plain", None, None, text))
            continue
        first, inner, rest = text[: a - lo], text[a - lo : b - lo], text[b - lo :]
        chars = int(points[k, 1] - points[k, 0]), int(points[k, 2] - points[k, 1])
        if h[k, 3] % 100 < spm_percent:
            rows.append(("spm", *chars, b"".join((s, rest, p, first, m, inner))))
        else:
            rows.append(("psm", *chars, b"".join((p, first, s, rest, m, inner))))
    form, prefix, middle, output = zip(*rows, strict=True)
    strings = pa.array(output, pa.binary()).cast(pa.string())
    return [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), strings]


NEW = [("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()), ("middle_chars", T.LongType()), ("output", T.StringType())]


def fill_in_middle(documents: DataFrame, seed: int = 1, percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """``documents`` (doc_id, text, ...) with n (units), form (plain, psm or spm), prefix_chars and middle_chars
    (code points; null if plain) and output. ``percent`` of the texts are rearranged, ``spm_percent`` of them
    with the suffix first; the hash of ``seed`` and the id decides."""
    keep = [f for f in documents.schema.fields if f.name.lower() not in {name for name, _ in NEW}]
    docs = documents.select([F.col(f"`{f.name}`") for f in keep])
    names = [f.name.lower() for f in keep]
    id_at, text_at = names.index("doc_id"), names.index("text")

    def run(batches):
        for batch in batches:
            for part in runs(batch, text_at, TOGETHER):
                new = _transform(part.column(id_at).to_pylist(), part.column(text_at), seed, percent, spm_percent)
                yield pa.RecordBatch.from_arrays([*part.columns, *new], [*part.schema.names, *(name for name, _ in NEW)])

    return in_arrow(docs, run, T.StructType([*keep, *(T.StructField(name, kind) for name, kind in NEW)]))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. No text that is rearranged holds a sentinel, and none arises where a
    part meets one, so an output has exactly three."""
    parts = F.split(output, "|".join(SENTINELS), -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


ORACLE = """
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(sha256('1:' || coalesce(doc_id::VARCHAR, '')), i, 8))::BIGINT) AS h FROM documents),
cut AS (
  SELECT doc_id, t, u, len(u) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
         WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM docs),
parts AS (
  SELECT *, array_to_string(u[:a], '') AS p, array_to_string(u[a + 1 : b], '') AS m, array_to_string(u[b + 1 :], '') AS s FROM cut)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""
