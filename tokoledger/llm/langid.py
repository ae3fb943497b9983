"""Language identification with a bidirectional GRU over UTF-8 bytes.

The network is trained in numpy by backpropagation through time, on a bounded
sample of labelled documents. Each position of a text is labelled from the
forward and the backward state; a document's probabilities are the mean over
all its positions. Texts are read whole, in consecutive windows of bytes, and
the state starts anew in each window, so a very long text costs no more memory
than a short one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokoledger.llm.common import id_bucket, in_arrow
from tokoledger.llm.pretokens import runs, slices

UNDETERMINED = "und"
WINDOW = 128            # bytes
BLOCK = 2048            # windows that are stepped together
WIDTH = 8               # states a direction
SAMPLE = 1000           # labelled documents a language that training draws from
SAMPLE_CHARS = 1000     # characters that training takes from each of them, at a random place
STEPS, BATCH, LENGTH, RATE = 160, 256, 32, 0.03


@dataclass
class Network:
    """Per direction: e (256 x 3h) input table with biases, u (h x 3h) recurrent weights; v, c: output."""

    languages: list[str]
    e: list[np.ndarray]
    u: list[np.ndarray]
    v: np.ndarray
    c: np.ndarray

    def params(self) -> list[np.ndarray]:
        return [*self.e, *self.u, self.v, self.c]


def _gate(x: np.ndarray) -> np.ndarray:
    """Hard sigmoid, clip(x / 4 + 1/2, 0, 1)."""
    return np.clip(0.25 * x + 0.5, 0, 1)


def new_network(languages: list[str], width: int = WIDTH, seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    e = [draw(256, 3 * width) for _ in range(2)]
    u = [draw(width, 3 * width) for _ in range(2)]
    return Network(languages, e, u, draw(2 * width, len(languages)), np.zeros(len(languages), np.float32))


def _step(e, u, x, h):
    """One GRU step; gates z (keep) and r (reset), candidate n."""
    w = u.shape[0]
    g, a = e[x], h @ u
    zr = _gate(g[:, :2 * w] + a[:, :2 * w])
    z, r = zr[:, :w], zr[:, w:]
    n = np.tanh(g[:, 2 * w:] + r * a[:, 2 * w:])
    return z, r, n, a[:, 2 * w:], n + z * (h - n)


def train(texts: list[bytes], labels: list[int], languages: list[str], steps: int = STEPS, seed: int = 7) -> Network:
    """Adam on the mean cross-entropy of all positions of random windows."""
    net, rng = new_network(languages, seed=seed), np.random.default_rng(seed)
    by_language = [[t for t, k in zip(texts, labels, strict=True) if k == i and t] for i in range(len(languages))]
    present = [i for i, ts in enumerate(by_language) if ts]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.params()]
    steps *= max(1, -(-len(present) // BATCH))  # every language has its turns
    for step in range(1, steps + 1):
        x, y = np.full((LENGTH, BATCH), 32, np.uint8), np.empty(BATCH, np.int64)
        first = (step - 1) * BATCH if len(present) > BATCH else 0
        for b in range(BATCH):
            y[b] = present[(first + b) % len(present)]
            text = by_language[y[b]][rng.integers(len(by_language[y[b]]))]
            at = rng.integers(max(1, len(text) - LENGTH + 1))
            part = np.frombuffer(text[at:at + LENGTH], np.uint8)
            x[:len(part), b] = part
        grads = _gradients(net, x, y)
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, (m, s) in zip(net.params(), grads, moments, strict=True):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
    return net


def _gradients(net: Network, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Backpropagation through time; x: (positions, windows) of bytes, y: languages."""
    length, batch = x.shape
    w = net.u[0].shape[0]
    tapes, states = [], np.zeros((length, batch, 2 * w), np.float32)
    for d in range(2):
        h, tape = np.zeros((batch, w), np.float32), []
        for t in range(length) if d == 0 else range(length - 1, -1, -1):
            z, r, n, an, new = _step(net.e[d], net.u[d], x[t], h)
            tape.append((t, h, z, r, n, an))
            h = new
            states[t, :, d * w:(d + 1) * w] = h
        tapes.append(tape)
    logits = states @ net.v + net.c
    p = np.exp(logits - logits.max(axis=2, keepdims=True))
    p /= p.sum(axis=2, keepdims=True)
    p[:, np.arange(batch), y] -= 1
    p /= length * batch
    flat = states.reshape(-1, 2 * w)
    gv, gc, into = flat.T @ p.reshape(-1, p.shape[2]), p.sum(axis=(0, 1)), p @ net.v.T
    ge, gu = [np.zeros_like(a) for a in net.e], [np.zeros_like(a) for a in net.u]
    order = np.argsort(x, axis=None, kind="stable")
    bytes_seen, first = np.unique(x.reshape(-1)[order], return_index=True)
    for d in range(2):
        carry, dg = np.zeros((batch, w), np.float32), np.empty((length, batch, 3 * w), net.v.dtype)
        for t, h, z, r, n, an in reversed(tapes[d]):
            dh = carry + into[t, :, d * w:(d + 1) * w]
            dn = dh * (1 - z) * (1 - n * n)
            dz = 0.25 * dh * (h - n) * ((z > 0) & (z < 1))
            dr = 0.25 * dn * an * ((r > 0) & (r < 1))
            da = np.concatenate([dz, dr, dn * r], axis=1)
            dg[t] = np.concatenate([dz, dr, dn], axis=1)
            gu[d] += h.T @ da
            carry = dh * z + da @ net.u[d].T
        ge[d][bytes_seen] = np.add.reduceat(dg.reshape(-1, 3 * w)[order], first, axis=0)
    return [*ge, *gu, gv, gc]


def _states(e, u, x, valid, backward: bool) -> np.ndarray:
    """All states of windows x (positions, windows). valid: lengths, or None if all are full."""
    length, batch = x.shape
    w = u.shape[0]
    uz, un = np.ascontiguousarray(0.25 * u[:, :2 * w]), np.ascontiguousarray(u[:, 2 * w:])
    ez, en = np.ascontiguousarray(0.25 * e[:, :2 * w] + 0.5), np.ascontiguousarray(e[:, 2 * w:])  # the gates' line, folded in
    out = np.empty((length, batch, w), np.float32)
    h = np.zeros((batch, w), np.float32)
    a, g = np.empty((batch, 2 * w), np.float32), np.empty((batch, 2 * w), np.float32)
    an, n = np.empty((batch, w), np.float32), np.empty((batch, w), np.float32)
    for t in range(length - 1, -1, -1) if backward else range(length):
        np.take(ez, x[t], axis=0, out=g, mode="clip")
        np.take(en, x[t], axis=0, out=n, mode="clip")
        np.matmul(h, uz, out=a)
        np.matmul(h, un, out=an)
        a += g
        np.maximum(a, 0, out=a)
        np.minimum(a, 1, out=a)
        an *= a[:, w:]
        n += an
        np.tanh(n, out=n)
        h = out[t]
        prev = out[t + 1 if backward else t - 1] if (t + 1 < length if backward else t > 0) else None
        if prev is None:
            np.multiply(n, 1 - a[:, :w], out=h)
        else:
            np.subtract(prev, n, out=h)
            h *= a[:, :w]
            h += n
        if valid is not None and backward:
            h[valid <= t] = 0
    return out


def label_positions(net: Network, windows: np.ndarray, valid: np.ndarray | None = None) -> np.ndarray:
    """(languages, positions, windows): probabilities of every position."""
    fwd = _states(net.e[0], net.u[0], windows, valid, False)
    bwd = _states(net.e[1], net.u[1], windows, valid, True)
    w = fwd.shape[2]
    logits = net.v[:w].T @ fwd.reshape(-1, w).T  # languages first: long rows are much faster to reduce
    logits += net.v[w:].T @ bwd.reshape(-1, w).T
    logits += net.c[:, None]
    logits -= logits.max(axis=0)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    return logits.reshape(-1, *windows.shape)


def document_probabilities(net: Network, texts: list[bytes]) -> np.ndarray:
    """Mean over all positions of each text; zeros for an empty one."""
    n = np.array([len(t) for t in texts], dtype=np.int64)
    total = np.zeros((len(texts), len(net.languages)))
    flat = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.cumsum(n) - n
    full = n // WINDOW
    doc = np.repeat(np.arange(len(texts)), full)
    at = np.repeat(starts, full) + WINDOW * (np.arange(len(doc)) - np.repeat(np.cumsum(full) - full, full))
    for lo in range(0, len(doc), BLOCK):
        x = np.ascontiguousarray(flat[at[lo:lo + BLOCK, None] + np.arange(WINDOW)].T)
        np.add.at(total, doc[lo:lo + BLOCK], label_positions(net, x).sum(axis=1).T)
    tail = np.nonzero(n % WINDOW)[0]
    tail = tail[np.argsort(n[tail] % WINDOW, kind="stable")]  # windows of similar length together
    for lo in range(0, len(tail), BLOCK // 4):
        d = tail[lo:lo + BLOCK // 4]
        valid = n[d] % WINDOW
        span = np.arange(valid.max())
        inside = span[:, None] < valid
        x = flat[np.minimum(starts[d] + full[d] * WINDOW + span[:, None], len(flat) - 1)]
        total[d] += (label_positions(net, x, valid) * inside).sum(axis=1).T
    return total / np.maximum(n, 1)[:, None]


def draw(docs: DataFrame, holdout: int = 2, parts: int = 4, sample: int = SAMPLE) -> tuple[list[str], list[bytes], list[int]]:
    """Languages, texts and their languages' numbers, of documents with a language whose id
    bucket is not ``holdout``: about ``sample`` of each language, drawn by a hash of the id,
    and ``SAMPLE_CHARS`` characters of each at a random place."""
    usable = docs.where(
        F.col("lang").isNotNull() & (id_bucket(F.col("doc_id"), parts) != holdout) & F.col("text").isNotNull()
    ).select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string"))
    counts = {r.lang: r.n for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts)
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, sample / counts[k]))]) if languages else F.lit(None)
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("drawn")), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)
    place = F.pmod(F.xxhash64("doc_id", F.lit("place")), F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS)).cast("int") + 1
    rows = (
        usable.where(drawn).select("doc_id", "lang", F.substring("text", place, F.lit(SAMPLE_CHARS)).alias("part"))
        .groupBy("doc_id", "lang").agg(F.min("part").alias("part")).orderBy("doc_id", "lang")
        .limit(2 * sample * len(languages)).collect()
    ) if languages else []
    number = {k: i for i, k in enumerate(languages)}
    return languages, [r.part.encode() for r in rows], [number[r.lang] for r in rows]


def fit(docs: DataFrame, holdout: int = 2, parts: int = 4, sample: int = SAMPLE, steps: int = STEPS) -> Network | None:
    """Train on a sample of the labelled documents (see ``draw``). None if there is no such document."""
    languages, texts, labels = draw(docs, holdout, parts, sample)
    return train(texts, labels, languages, steps) if any(texts) else None


# classes of bytes: 0 for what is no letter, the letters a to z without their case, each byte beyond ASCII
_CLASS = np.zeros(256, np.int16)
_CLASS[65:91] = _CLASS[97:123] = np.arange(1, 27)
_CLASS[128:] = np.arange(27, 155)
_CLASSES = 155
_PAIRS_OF = 1 << 18     # bytes whose pairs are held at once


def _pairs(text: bytes, before: bytes = b" ") -> np.ndarray:
    """Number of each letter of the text together with the byte before it."""
    c = _CLASS[np.frombuffer(before + text, np.uint8)]
    return (c[:-1] * _CLASSES + c[1:])[c[1:] > 0]


@dataclass
class Usual:
    """How well a text fits one language, whatever the others are: the surprisal (bits) of a
    letter after the byte before it, and the largest mean of a text that fits."""

    bits: np.ndarray    # languages x pairs
    limit: np.ndarray   # of a long text's mean
    spread: np.ndarray  # of one letter's bits, which a short text's mean may be off by

    def fits(self, language: int, text: bytes) -> bool:
        total, n = 0.0, 0
        for lo in range(0, len(text), _PAIRS_OF):
            at = _pairs(text[lo:lo + _PAIRS_OF], text[lo - 1:lo] or b" ")
            total, n = total + float(self.bits[language][at].sum(dtype=np.float64)), n + len(at)
        return not n or bool(total / n <= self.limit[language] + 3 * self.spread[language] / math.sqrt(n))


def usual(net: Network, texts: list[bytes], labels: list[int]) -> Usual:
    """Learned from every other text of a language and calibrated on the rest. The limit lies
    halfway between their median and the language's letters at random, and six deviations
    (of the median) above the median at least. Texts that the network gives another
    language do not count, unless there are no others."""
    own = document_probabilities(net, texts).argmax(axis=1) == np.array(labels)
    n = len(net.languages)
    bits, limit, spread = np.zeros((n, _CLASSES * _CLASSES), np.float32), np.full(n, np.inf), np.zeros(n)
    of: list[list] = [[] for _ in range(n)]
    for t, label, ok in zip(texts, labels, own, strict=True):
        if len(found := _pairs(t)):
            of[label].append((ok, found))
    for k, found in enumerate(of):
        mine = [m for ok, m in found if ok] or [m for _, m in found]
        if not mine:
            continue
        count = np.bincount(np.concatenate(mine[::2]), minlength=_CLASSES * _CLASSES).reshape(_CLASSES, _CLASSES)
        table = -np.log2((count + 0.01) / (count + 0.01).sum(axis=1, keepdims=True))
        bits[k] = table.reshape(-1)
        rest = mine[1::2] or mine
        mean = np.array([bits[k][m].mean() for m in rest])
        middle = np.median(mean)
        letters = np.nonzero(count.sum(axis=0) >= 0.001 * count.sum())[0]
        chance = table[np.ix_(letters, letters)].mean()
        limit[k] = middle + max((chance - middle) / 2, 6 * 1.4826 * float(np.median(np.abs(mean - middle))))
        spread[k] = bits[k][np.concatenate(rest)].std()
    return Usual(bits, limit, spread)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def judge(net: Network | None, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and score of whole texts, in slices of bounded size."""
    out: list[tuple[str, float]] = []
    for part in slices(texts, lambda t: len(t or "")):
        letter = [has_letter(t) for t in part]
        if net is None:
            out += [(UNDETERMINED, 0.0)] * len(part)
            continue
        p = document_probabilities(net, [t.encode() if ok else b"" for t, ok in zip(part, letter, strict=True)])
        best = p.argmax(axis=1)
        out += [
            (net.languages[k], float(min(1.0, p[i, k]))) if ok else (UNDETERMINED, 0.0)
            for i, (k, ok) in enumerate(zip(best, letter, strict=True))
        ]
    return out


def _predict(net: Network | None):
    def run(batches):
        for batch in (part for whole in batches for part in runs(whole, 1, 2_000_000)):
            found = judge(net, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    return run


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """``(doc_id, lang_pred, score)`` for every row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return in_arrow(rows, _predict(net), "doc_id long, lang_pred string, score double")


def language_id(docs: DataFrame, holdout: int = 2, parts: int = 4, net: Network | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred,
    score (the mean probability of lang_pred over all positions).

    A text that is null or has no letter is ``und`` with score 0, and so is every
    text where there is nothing to learn from. A null doc_id is not held out
    and not learned from. Repeated rows stay repeated and count once in
    training. Columns beside doc_id, text and lang are not read.
    """
    net = net or fit(docs, holdout, parts)
    return identify(docs, net).select(
        "doc_id", F.coalesce(id_bucket(F.col("doc_id"), parts) == holdout, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
