"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line is labelled good or bad. What speaks for a line's label are binned features of the
line itself and of the lines before and after it; transitions tie the labels of neighbours
together. The marginals of forward-backward, weighted by the lines' lengths, give the
document's quality.

Forward-backward runs over many documents at once as running products of 2 x 2 matrices:
the matrix of a document's first line has equal rows, so the product forgets what came before,
and log2(lines of the longest document) vector steps do, however many lines a document has.

The field is fitted on windows of neighbouring lines of a bounded sample of labelled documents;
all lines of a window carry the label of their document.

Null and empty texts are one empty line. Labels that contradict each other, are null or not 0 or 1,
or have no id teach nothing. If one of the two labels is missing, every text gets the share of
good ones, (good + 1) / (all + 2). Rows repeat as often as they are given; an empty table gives
no rows. Columns other than doc_id, text and the label are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokoledger.llm.common import id_bucket, in_arrow
from tokoledger.llm.pretokens import runs

ROWS = 1000                  # sampled labelled documents of each label
WINDOWS = 1500               # sampled windows of each label
WINDOW = 64                  # lines of a window
BINS = 8                     # bins of a feature, and one more for a line that is not there
TOGETHER = 4_000_000         # bytes of text that are labelled together
STEPS, RATE, DECAY = 100, 0.2, 3e-3

#: Kinds of bytes whose share of a line is a feature; the first is the lead bytes of non-ASCII code points.
_KINDS = [bytes(range(0xC0, 256)), bytes(range(48, 58)), b"#$%&*+/<=>@[\\]^_`{}~", b"!?", b"|", b".,;:"]
_NAMES = ("bytes", "upper", "foreign", "digits", "symbols", "cries", "bars", "stops", "words", "word length", "distinct", "distinct pairs", "doubled", "in line before", "seen before")


def _table(kind: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(kind)] = True
    return found


_IS = [_table(k) for k in _KINDS]
_UPPER, _LETTER = _table(bytes(range(65, 91))), _table(bytes([*range(65, 91), *range(97, 123)]))


def _counts(flags: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[stops] - sums[starts]


def _word_features(lines: list[bytes]) -> list[tuple]:
    """Per line of one document: words, their bytes, distinct words, distinct pairs, words that follow themselves,
    distinct words of the line before, seen before."""
    out, before, seen = [], frozenset(), set()
    for line in lines:
        words = line.split()
        distinct = set(words)
        pairs = len(set(zip(words, words[1:], strict=False)))
        doubled = sum(map(eq, words, words[1:]))
        out.append((len(words), sum(map(len, words)), len(distinct), pairs, doubled, len(distinct & before), bool(words) and line in seen))
        seen.add(line)
        before = distinct
    return out


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, the lines of each text, and the weights (bytes + 1) of the lines."""
    split = [(t or "").encode().split(b"\n") for t in texts]
    n_lines = np.fromiter(map(len, split), np.int64, len(split))
    size = np.fromiter((len(line) for lines in split for line in lines), np.int64)
    data = np.frombuffer(b"".join(line for lines in split for line in lines), np.uint8)
    stops = np.cumsum(size)
    starts = stops - size
    letters = np.maximum(_counts(_LETTER[data], starts, stops), 1)
    most = np.maximum(size, 1)
    columns = [np.log1p(size), _counts(_UPPER[data], starts, stops) / letters]
    columns += [_counts(kind[data], starts, stops) / most for kind in _IS]
    words, word_bytes, distinct, pairs, doubled, common, seen = np.array([row for lines in split for row in _word_features(lines)], np.float64).reshape(-1, 7).T
    some = np.maximum(words, 1)
    columns += [np.log1p(words), word_bytes / some, np.where(words > 0, distinct / some, 1), np.where(words > 1, pairs / np.maximum(words - 1, 1), 1)]
    columns += [doubled / np.maximum(words - 1, 1), common / np.maximum(distinct, 1), seen]
    return np.column_stack(columns).astype(np.float32), n_lines, size + 1


def edges_of(values: np.ndarray) -> list[np.ndarray]:
    """Bin edges of each feature: just above its least value, then quantiles of what lies above that."""
    out = []
    for column in values.T:
        least = column.min()
        above = column[column > least]
        cut = np.quantile(above, np.arange(1, BINS - 1) / (BINS - 1)) if len(above) else np.zeros(0)
        out.append(np.unique(np.concatenate(([np.nextafter(least, np.float32(np.inf))], cut)).astype(np.float32)))
    return out


def binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, column, side="right") for e, column in zip(edges, values.T, strict=True)])


def with_neighbours(bins: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Bins of the line, of the line before and of the line after; BINS stands for a line that is not there."""
    before, after = np.full_like(bins, BINS), np.full_like(bins, BINS)
    before[1:], after[:-1] = bins[:-1], bins[1:]
    before[first], after[last] = BINS, BINS
    return np.hstack((bins, before, after))


def _products(m: np.ndarray, longest: int, suffix: bool = False) -> np.ndarray:
    """Running products of the 2 x 2 matrices ``m[:, :, k]``, scaled, over the last (or next) ``longest`` ones at least."""
    p, step = m.copy(), 1
    while step < longest:
        left, right = p[:, :, :-step], p[:, :, step:]
        joined = left[:, 0, None] * right[0, None] + left[:, 1, None] * right[1, None]
        joined /= joined.max(axis=(0, 1))
        if suffix:
            p[:, :, :-step] = joined
        else:
            p[:, :, step:] = joined
        step *= 2
    return p


def marginals(logit: np.ndarray, trans: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chance of good for each line, and of each pair of labels (that of the line before, its own, per line);
    ``first`` marks the lines that begin a chain, whose pairs are 0."""
    n = len(logit)
    if not n:
        return np.zeros(0), np.zeros((2, 2, 0))
    top = np.maximum(logit, 0)
    emit = np.stack((np.exp(-top), np.exp(logit - top)))
    step = np.exp(trans - trans.max())
    m = np.where(first, 1.0, step[:, :, None]) * emit
    longest = int(np.diff(np.append(np.flatnonzero(first), n)).max())
    alpha = _products(m, longest)[0]
    behind = _products(m, longest, suffix=True).sum(axis=1)
    beta = np.ones((2, n))
    beta[:, :-1] = np.where(first[1:], 1.0, behind[:, 1:])
    both = alpha * beta
    pair = np.zeros((2, 2, n))
    pair[:, :, 1:] = alpha[:, None, :-1] * m[:, :, 1:] * beta[None, :, 1:]
    pair[:, :, first] = 0
    total = pair.sum(axis=(0, 1))
    return both[1] / both.sum(axis=0), np.divide(pair, total, out=pair, where=total > 0)


def places(at: np.ndarray) -> np.ndarray:
    """Which weight each bin has."""
    return at + (BINS + 1) * np.arange(at.shape[1])


@dataclass
class Field:
    edges: list[np.ndarray]
    weights: np.ndarray          # one for each feature of the three lines and each bin
    bias: float
    trans: np.ndarray

    def logits(self, at: np.ndarray) -> np.ndarray:
        """``at``: bins of the lines, see :func:`with_neighbours`."""
        return self.weights.ravel().take(places(at)).sum(axis=1) + self.bias

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Length-weighted chance of good of each text's lines."""
        if not texts:
            return np.zeros(0)
        values, n_lines, weight = features(texts)
        ends = np.cumsum(n_lines)
        first, last = np.zeros(len(values), bool), np.zeros(len(values), bool)
        first[ends - n_lines], last[ends - 1] = True, True
        good, _ = marginals(self.logits(with_neighbours(binned(values, self.edges), first, last)), self.trans, first)
        return np.minimum(np.add.reduceat(good * weight, ends - n_lines) / np.add.reduceat(weight, ends - n_lines), 1.0)


def gradient(field: Field, place: np.ndarray, label: np.ndarray, share: np.ndarray, first: np.ndarray) -> tuple:
    """Gradient of the weighted log likelihood: for the weights, the bias and the transitions."""
    good, pair = marginals(field.weights.ravel().take(place).sum(axis=1) + field.bias, field.trans, first)
    rest = (label - good) * share
    of_weights = np.bincount(place.ravel(), np.repeat(rest, place.shape[1]), field.weights.size).reshape(field.weights.shape)
    of_trans = -(pair * share).sum(axis=2)
    inner = ~first
    of_trans[1, 1] += share[inner & (label == 1)].sum()
    of_trans[0, 0] += share[inner & (label == 0)].sum()
    return of_weights, rest.sum(), of_trans


def train(windows: list[tuple[int, bool, bool, np.ndarray]], prior: float) -> Field:
    """``windows``: label, whether a line before and after is there beside the window's own, features of all these
    lines. ``prior``: share of good among the labelled documents."""
    edges = edges_of(np.concatenate([values for *_, values in windows]))
    count = [sum(label == k for label, *_ in windows) for k in (0, 1)]
    at, label, share, first = [], [], [], []
    for y, before, after, values in windows:
        ends = np.zeros(len(values), bool), np.zeros(len(values), bool)
        ends[0][0] = ends[1][-1] = True
        own = slice(int(before), len(values) - int(after))
        bins = with_neighbours(binned(values, edges), *ends)[own]
        at.append(bins)
        label.append(np.full(len(bins), y))
        share.append(np.full(len(bins), (prior if y else 1 - prior) / count[y]))
        first.append(np.arange(len(bins)) == 0)
    at, label, share, first = map(np.concatenate, (at, label, share, first))
    field = Field(edges, np.zeros((at.shape[1], BINS + 1)), 0.0, np.zeros((2, 2)))
    place = places(at)
    parts = [field.weights, np.zeros(1), field.trans]
    mean, spread = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for step in range(1, STEPS + 1):
        slopes = gradient(field, place, label, share, first)
        for part, slope, m, v in zip(parts, slopes, mean, spread, strict=True):
            slope = slope - DECAY * part
            m += 0.1 * (slope - m)
            v += 0.001 * (slope * slope - v)
            part += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        field.bias = float(parts[1][0])
    return field


def _cut(batches):
    """Windows of each labelled text: label, order, whether lines before and after are there, features."""
    for batch in batches:
        for part in runs(batch, 0, TOGETHER):
            texts, labels = part.column(0).to_pylist(), part.column(1).to_pylist()
            values, n_lines, _ = features(texts)
            out, at = [], 0
            for label, n in zip(labels, n_lines.tolist(), strict=True):
                for lo in range(0, n, WINDOW):
                    hi = min(lo + WINDOW, n)
                    before, after = lo > 0, hi < n
                    raw = values[at + lo - before : at + hi + after].tobytes()
                    out.append((label, xxhash.xxh64_intdigest(raw) >> 1, before, after, raw))
                at += n
            kinds = [pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([row[k] for row in out], kind) for k, kind in enumerate(kinds)], ["label", "turn", "before", "after", "lines"])


def fit(documents: DataFrame, labels: DataFrame, holdout: int, parts: int, label: str = "quality", rows: int = ROWS, windows: int = WINDOWS) -> Field | float:
    """The field, or the share of good where a label is missing. Learns from ``rows`` documents of each label outside the
    held-out bucket, drawn by a hash of the id, and from ``windows`` windows of their whole texts for each label."""
    y = F.col(f"`{label}`").cast("int")
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(y).alias("y"), F.max(y).alias("other")).where("y = other AND y IN (0, 1)")
    docs = documents.select("doc_id", "text").where(id_bucket(F.col("doc_id"), parts) != holdout)
    taught = docs.select("doc_id").distinct().join(known.select("doc_id", "y"), "doc_id")
    count = {row.y: row.n for row in taught.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = (count.get(1, 0) + 1) / (sum(count.values()) + 2)
    if len(count) < 2:
        return prior
    turn = F.xxhash64("doc_id"), F.col("doc_id")
    drawn = [taught.where(F.col("y") == k).orderBy(*turn).limit(rows) for k in (0, 1)]
    sample = docs.join(F.broadcast(drawn[0].unionByName(drawn[1])), "doc_id").select("text", "y")
    cut = in_arrow(sample, _cut, "label int, turn long, before boolean, after boolean, lines binary")
    cut = cut.groupBy("label", "turn", "before", "after", "lines").agg(F.count(F.lit(1)).alias("n")).drop("n").persist()
    found = [row for k in (0, 1) for row in cut.where(F.col("label") == k).orderBy("turn", "lines", "before", "after").limit(windows).collect()]
    cut.unpersist()
    if {row.label for row in found} != {0, 1}:
        return prior
    return train([(row.label, row.before, row.after, np.frombuffer(row.lines, np.float32).reshape(-1, len(_NAMES))) for row in found], prior)


def quality(documents: DataFrame, labels: DataFrame, holdout: int = 1, parts: int = 3, label: str = "quality", rows: int = ROWS, windows: int = WINDOWS) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for each row of ``documents``; see the module. held_out: the id's bucket
    (crc32 of its text modulo ``parts``) is ``holdout``; false for a null id."""
    field = fit(documents, labels, holdout, parts, label, rows, windows)
    docs = documents.select("doc_id", F.coalesce(id_bucket(F.col("doc_id"), parts) == holdout, F.lit(False)).alias("held_out"), "text")

    def run(batches):
        for batch in batches:
            for part in runs(batch, 2, TOGETHER):
                score = np.full(part.num_rows, field) if isinstance(field, float) else field.scores(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return in_arrow(docs, run, f"doc_id {kind}, held_out boolean, score double, predicted int")
