"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

A bounded sample of labelled documents is the index: TF-IDF weights of all
their words. Examples are cut into blocks. The lists of rare words are read
whole; the lists of frequent words lie block by block, each block with the
largest weight of every word. Both give a block an upper bound of its best
cosine; blocks are read from the highest bound down, for many texts at once,
and a text skips every block whose bound is below the k-th best cosine that it
has found, so the neighbours are exact.
The index is made twice: over all words, and over the terms that tell the
classes apart, which the other words of a text cannot outweigh. Votes are
weighted by distance; one logistic function of both votes is fitted on the
examples themselves, each one left out of its own votes, and gives the score.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokoledger.llm.common import id_bucket, in_arrow, ship, stored
from tokoledger.llm.pretokens import runs

SAMPLE = {1: 2500, 0: 5000}   # labelled documents of each class that are indexed, about
NEIGHBOURS = 15
BLOCK = 512                   # examples of a block
FREQUENT = 16                 # a word of more than one in so many examples is frequent
DENSE_BYTES = 24_000_000      # memory of the frequent words' blocks; a word beyond is read as a rare one
TOGETHER = 64                 # texts whose neighbours are searched at once, at most
POSTS = 1_000_000             # postings of rare words read at once, unless a single text has more
MIN_CHI2, MIN_PHI2 = 30.0, 0.01
EVIDENCE = 5
KEPT = 100_000                # words that a worker remembers
KEPT_TEXTS = 20_000           # texts whose result a worker remembers

_WORD = re.compile(r"\w+")


def terms_of(text: str | None) -> Counter:
    return Counter(w for raw in (text or "").lower().split() for w in _WORD.findall(raw))


@dataclass
class Index:
    terms: dict[str, int]                 # numbered from the most frequent on
    idf: np.ndarray
    unseen: float                         # IDF of a word that no example has
    ids: list[int]                        # doc_id of each example
    toxic: np.ndarray
    weight: np.ndarray                    # documents that an example stands for
    empty_score: float                    # of a text without any of the terms
    dense: np.ndarray                     # per block, frequent word and example: weight
    block_max: np.ndarray                 # per block and frequent word: largest weight
    starts: np.ndarray                    # per rare word: first posting
    at: np.ndarray                        # postings of the rare words, by word and example: examples
    value: np.ndarray                     # their weights
    model: tuple[float, float, float] = (0.0, 0.0, 0.0)   # of the whole vote, the vote by terms, constant
    whole: Index | None = None            # the same examples over all their words

    @property
    def posts(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Postings of the terms: examples, weights."""
        frequent = [row.reshape(-1) for row in self.dense.transpose(1, 0, 2)]
        return [(np.nonzero(row)[0], row[row > 0]) for row in frequent] + [
            (self.at[lo:hi], self.value[lo:hi]) for lo, hi in zip(self.starts[:-1], self.starts[1:], strict=True)]

    def vector(self, counts: dict[int, int], others=()) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights of unit length; ``others``: counts of words that no example has."""
        t, c = np.fromiter(counts.keys(), np.int64, len(counts)), np.fromiter(counts.values(), float, len(counts))
        order = np.argsort(t)
        t = t[order]
        w = (1 + np.log(c[order])) * self.idf[t]
        rest = sum((1 + math.log(c)) ** 2 for c in others) * self.unseen ** 2
        return t, w / np.sqrt((w * w).sum() + rest)

    def nearest(self, t: np.ndarray, w: np.ndarray, k: int = NEIGHBOURS, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of highest cosine above zero (all, if fewer), ties to the
        smaller example; ``without``: an example that takes no part."""
        return next(self.nearest_of([(t, w)], k, [without]))

    def nearest_of(self, vectors: list, k: int = NEIGHBOURS, without: list[int] | None = None) -> Iterator:
        """``nearest`` of each vector."""
        h = self.dense.shape[1]
        cuts = [int(np.searchsorted(t, h)) for t, _ in vectors]
        posts = [int((self.starts[t[c:] - h + 1] - self.starts[t[c:] - h]).sum()) for (t, _), c in zip(vectors, cuts, strict=True)]
        lo = 0
        while lo < len(vectors):
            hi, read = lo + 1, posts[lo]
            while hi < min(len(vectors), lo + TOGETHER) and read + posts[hi] <= POSTS:
                read += posts[hi]
                hi += 1
            yield from self._nearest(vectors[lo:hi], cuts[lo:hi], k, (without or [-1] * len(vectors))[lo:hi])
            lo = hi

    def _nearest(self, vectors: list, cuts: list[int], k: int, without: list[int]) -> list:
        (blocks, h, size), q = self.dense.shape, len(vectors)
        frequent = np.zeros((q, h))
        for i, ((t, w), cut) in enumerate(zip(vectors, cuts, strict=True)):
            frequent[i, t[:cut]] = w[:cut]
        rare = [(t[cut:] - h, w[cut:]) for (t, w), cut in zip(vectors, cuts, strict=True)]
        t, w = (np.concatenate(x) for x in zip(*rare, strict=True))
        row = np.repeat(np.arange(q) * (blocks * size), [len(x) for x, _ in rare])
        first, n = self.starts[t], self.starts[t + 1] - self.starts[t]
        post = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        scores = np.bincount(np.repeat(row, n) + self.at[post], np.repeat(w, n) * self.value[post], q * blocks * size)
        scores = scores.astype(float, copy=False).reshape(q, blocks, size)   # whole numbers where nothing was read
        bounds = frequent @ self.block_max.T + scores.max(axis=2, initial=0.0)
        best = np.zeros((q, k))               # the k best cosines so far, the smallest first
        unread = np.ones((q, blocks), dtype=bool)
        out = np.array(without)
        for b in np.argsort(-bounds.max(axis=0), kind="stable"):
            on = np.nonzero((bounds[:, b] > 0) & (bounds[:, b] >= best[:, 0] - 1e-12))[0]
            found = np.round(frequent[on] @ self.dense[b] + scores[on, b], 12)
            left_out = np.nonzero(out[on] // size == b)[0]
            found[left_out, out[on][left_out] % size] = 0
            scores[on, b], unread[on, b] = found, False
            best[on] = np.partition(np.concatenate([best[on], found], axis=1), -k, axis=1)[:, -k:]
        scores[unread] = 0
        result = []
        for line, least in zip(scores.reshape(q, blocks * size), best[:, 0], strict=True):
            here = np.nonzero((line > 0) & (line >= least))[0]
            here = here[np.lexsort((here, -line[here]))[:k]]
            result.append((here, line[here]))
        return result

    def vote(self, near: np.ndarray, cosine: np.ndarray) -> float:
        """Share of toxic among the neighbours, weighted by distance; without neighbours,
        among the examples without a term."""
        if not len(near):
            return self.empty_score
        w = self.weight[near] / (0.05 + np.maximum(0.0, 1 - cosine))
        return float((w * self.toxic[near]).sum() / w.sum())

    def calibrated(self, whole: float, telling: float) -> float:
        a, b, c = self.model
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a * whole + b * telling + c))))


def select_terms(examples: DataFrame) -> list[str]:
    """Terms of ``examples(toxic, terms, counts)`` that go with toxic ones: chi-square
    significant, and not by size alone. Copies of an example within a class count once."""
    distinct = examples.withColumn("content", F.xxhash64("terms", "counts")).dropDuplicates(["toxic", "content"])
    n, n1 = distinct.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < n1 < n:
        return []
    d, a = F.col("d").cast("double"), F.col("a").cast("double")
    phi2 = (a * n - d * n1) ** 2 / (d * (n - d) * (float(n1) * (n - n1)))
    found = (
        distinct.select("toxic", F.explode("terms").alias("term")).groupBy("term")
        .agg(F.count(F.lit(1)).alias("d"), F.sum("toxic").alias("a")).where(d < n)
        .where((a * n > d * n1) & (phi2 >= MIN_PHI2) & (phi2 * n >= MIN_CHI2)).select("term")
    )
    return sorted(r.term for r in found.collect())


def build(terms: list[str] | None, ids: list[int], examples: list[tuple[list[str], list[int]]], toxic: list[int], weight: list[float],
          block: int = BLOCK) -> tuple[Index, np.ndarray]:
    """The index over examples (of each, its words and their counts), and the vote of each
    example's other neighbours. ``terms``: the words that count, all if None."""
    y, w = np.array(toxic, dtype=float), np.array(weight, dtype=float)
    if terms is not None:
        chosen = set(terms)
        found = [[(v, c) for v, c in zip(ws, cs, strict=True) if v in chosen] for ws, cs in examples]
        examples = [([v for v, _ in f], [c for _, c in f]) for f in found]
    # examples that share their most frequent words share blocks, which makes the blocks' bounds tight
    leading = [[v for _, v in sorted(zip([-c for c in cs], ws, strict=True))[:3]] for ws, cs in examples]
    order = sorted((i for i, (ws, _) in enumerate(examples) if ws), key=lambda i: (leading[i], ids[i]))
    empty = [i for i, (ws, _) in enumerate(examples) if not ws]
    words: dict[str, int] = {}
    numbers = [np.array([words.setdefault(v, len(words)) for v in examples[i][0]], dtype=np.int64) for i in order]
    word = np.concatenate([np.zeros(0, np.int64), *numbers])
    count = np.concatenate([np.zeros(0), *(np.array(examples[i][1], dtype=float) for i in order)])
    ends = np.cumsum([0, *map(len, numbers)])
    example = np.repeat(np.arange(len(order)), np.diff(ends))
    df = np.bincount(word, minlength=len(words))
    by_df = np.argsort(-df, kind="stable")
    number = np.argsort(by_df)
    word, df = number[word], df[by_df]
    idf = np.log((1 + len(examples)) / (1 + df)) + 1
    value = (1 + np.log(count)) * idf[word]
    value /= np.sqrt(np.bincount(example, value * value, len(order)))[example]
    blocks = max(1, -(-len(order) // block))
    h = min(int((df * FREQUENT > len(order)).sum()), DENSE_BYTES // (8 * blocks * block))
    dense = np.zeros((blocks, h, block))
    head = word < h
    dense[example[head] // block, word[head], example[head] % block] = value[head]
    tail = np.nonzero(~head)[0]
    tail = tail[np.argsort(word[tail], kind="stable")]
    total = w[empty].sum()
    idx = Index(
        {v: int(number[i]) for v, i in words.items()}, idf, math.log(1 + len(examples)) + 1, [ids[i] for i in order], y[order], w[order],
        float((w[empty] * y[empty]).sum() / total) if total else 0.0, dense, dense.max(axis=2, initial=0.0),
        np.cumsum([0, *df[h:]]), example[tail].astype(np.int32), value[tail],
    )
    vectors = []
    for lo, hi in zip(ends[:-1], ends[1:], strict=True):
        by = np.argsort(word[lo:hi])
        vectors.append((word[lo:hi][by], value[lo:hi][by]))
    votes = np.full(len(examples), idx.empty_score)
    for i, found in zip(order, idx.nearest_of(vectors, without=list(range(len(order)))), strict=True):
        votes[i] = idx.vote(*found)
    return idx, votes


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps, with a weak prior; a constant comes
    last. No vote may count for the other class: a column with a negative slope is left out."""
    used = list(range(x.shape[1]))
    while True:
        z = np.column_stack([x[:, used], np.ones(len(x))])
        beta = np.array([4.0 / max(1, len(used))] * len(used) + [-2.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
            gradient = z.T @ (w * (p - y)) + 0.02 * beta
            step = np.linalg.solve(z.T @ (z * (w * p * (1 - p) + 1e-9)[:, None]) + 0.02 * np.eye(len(beta)), gradient)
            beta = beta - step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        if not used or beta[:-1].min() >= 0:
            result = np.zeros(x.shape[1] + 1)
            result[[*used, -1]] = beta
            return result
        used.pop(int(beta[:-1].argmin()))


def _term_rows(batches):
    for batch in (part for whole in batches for part in runs(whole, 2, 2_000_000)):
        found = [terms_of(t) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([list(c) for c in found], pa.list_(pa.string())),
             pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))],
            ["doc_id", "toxic", "terms", "counts"],
        )


def fit(docs: DataFrame, labels: DataFrame, holdout: int = 0, parts: int = 5, sample: dict[int, int] | None = None) -> Index | None:
    """The index over a sample of the labelled documents whose id bucket is not
    ``holdout``: about ``sample[class]`` of each class, drawn by a hash of the id.
    Repeated labels of a document count as toxic if one of them does; null labels
    do not count. None if nothing can be learned."""
    sample = sample or SAMPLE
    known = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where("toxic in (0, 1)")
        .where(id_bucket(F.col("doc_id"), parts) != holdout).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    n = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n:
        return None
    share = {k: min(1.0, sample[k] / n[k]) for k in n}
    limit = F.when(F.col("toxic") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0)) * (1 << 20)
    drawn = known.where(F.pmod(F.xxhash64("doc_id", F.lit("drawn")), F.lit(1 << 20)) < limit).limit(2 * sum(sample.values()))
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    examples = stored(in_arrow(
        texts.join(F.broadcast(drawn), "doc_id").select("doc_id", "toxic", "text"),  # bounded by the sample
        _term_rows, "doc_id long, toxic int, terms array<string>, counts array<int>",
    ).dropDuplicates(["doc_id"]))
    terms = select_terms(examples)
    # two strings an example instead of arrays: short rows for the driver
    rows = examples.select(
        "doc_id", "toxic", F.concat_ws(" ", "terms").alias("words"), F.concat_ws(" ", F.col("counts").cast("array<string>")).alias("counts")
    ).orderBy("doc_id").collect()
    if not rows:
        return None
    sampled = (
        [r.doc_id for r in rows], [(list(map(sys.intern, r.words.split(" "))) if r.words else [], list(map(int, r.counts.split()))) for r in rows],
        [r.toxic for r in rows], [1 / share[r.toxic] for r in rows],
    )
    del rows
    (index, by_terms), (index.whole, by_all) = build(terms, *sampled), build(None, *sampled)
    said = np.array([bool(ws) for ws, _ in sampled[1]])
    votes = np.column_stack([by_all, by_terms])[said]
    index.model = tuple(map(float, _logistic(
        np.concatenate([[[0, 0], [1, 1]], votes]), np.concatenate([[0, 1], np.array(sampled[2])[said]]), np.concatenate([[1, 1], np.array(sampled[3])[said]]))))
    return index


class _Numbers(dict):
    """Raw word -> numbers of its index words, the word itself if no example has it;
    remembers a bounded number of words."""

    def __init__(self, words: dict[str, int]):
        super().__init__()
        self.words = words

    def __missing__(self, raw: str) -> tuple:
        found = tuple(self.words.get(w, w) for w in _WORD.findall(raw))
        if len(self) < KEPT:
            self[raw] = found
        return found


class Scorer:
    """Texts -> (score, evidence, matched terms) of each; remembers the results of a bounded number of texts."""

    def __init__(self, index: Index | None):
        self.index, self.seen = index, {}
        self.names = sorted(index.terms, key=index.terms.get) if index else []
        self.numbers = _Numbers(index.whole.terms) if index else None
        self.telling = {index.whole.terms[w]: i for w, i in index.terms.items()} if index else {}

    def __call__(self, texts: list[str | None]) -> list[tuple[float, list[int], list[str]]]:
        if self.index is None:
            return [(0.0, [], [])] * len(texts)
        keys = [blake2b((t or "").encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in texts]
        new = {key: t or "" for key, t in zip(keys, texts, strict=True) if key not in self.seen}
        found = dict(zip(new, self._judge(list(new.values())), strict=True))
        result = [self.seen.get(key) or found[key] for key in keys]
        self.seen.update(islice(found.items(), max(0, KEPT_TEXTS - len(self.seen))))
        return result

    def _judge(self, texts: list[str]) -> list[tuple[float, list[int], list[str]]]:
        telling, whole = self.index, self.index.whole
        known, terms, by_all, by_terms = [], [], [], []
        for text in texts:
            every = Counter(chain.from_iterable(map(self.numbers.__getitem__, text.lower().split())))
            known.append({t: c for t, c in every.items() if type(t) is int})
            terms.append({self.telling[t]: c for t, c in every.items() if t in self.telling})
            by_all.append(whole.vector(known[-1], [c for t, c in every.items() if type(t) is str]) if known[-1] else None)
            by_terms.append(telling.vector(terms[-1]) if terms[-1] else None)
        near = whole.nearest_of([v for v in by_all if v])
        near_terms = telling.nearest_of([v for v in by_terms if v])
        result = []
        for a, b, matched in zip(by_all, by_terms, terms, strict=True):
            if not a:
                result.append((whole.empty_score, [], []))
                continue
            found = next(near)
            vote, vote_terms, evidence = whole.vote(*found), telling.empty_score, [whole.ids[i] for i in found[0][:EVIDENCE]]
            if b:
                found = next(near_terms)
                vote_terms = telling.vote(*found)
                if vote_terms >= vote:
                    evidence = [telling.ids[i] for i in found[0][:EVIDENCE]]
            result.append((telling.calibrated(vote, vote_terms), evidence, [self.names[i] for i in sorted(matched)]))
        return result


def scorer_of(spark: SparkSession, index: Index | None):
    """A function that gives a task its ``Scorer``; the index is broadcast (it is as large as the
    bounded sample), so that a worker reads it once, and its scorer serves all its tasks."""
    ship(spark)
    sent = spark.sparkContext.broadcast(index)

    def scorer() -> Scorer:
        index = sent.value
        made = getattr(index, "scorer", None)
        if made is None:
            made = Scorer(index)
            if index is not None:
                index.scorer = made
        return made

    return scorer


def _score(scorer_of_task):
    def run(batches):
        scorer = scorer_of_task()
        for batch in (part for whole in batches for part in runs(whole, 1, 2_000_000)):
            found = scorer(batch.column(1).to_pylist())
            score, evidence, matched = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score, pa.float64()), pa.array(evidence, pa.list_(pa.int64())), pa.array(matched, pa.list_(pa.string()))],
                ["doc_id", "score", "evidence", "matched_terms"],
            )

    return run


def score(docs: DataFrame, index: Index | None) -> DataFrame:
    """``(doc_id, score, evidence, matched_terms)`` for every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return in_arrow(rows, _score(scorer_of(docs.sparkSession, index)), "doc_id long, score double, evidence array<long>, matched_terms array<string>")


def toxicity(docs: DataFrame, labels: DataFrame, holdout: int = 0, parts: int = 5, index: Index | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score (0 to 1),
    predicted (1 if the score is at least 0.5), evidence (doc_id of the nearest
    examples) and matched_terms.

    A null or empty text, like any other without a word of the index, has the share
    of toxic among examples without a word. Without usable labels every score is 0. A null
    doc_id is not held out. Repeated rows stay repeated. Columns beside doc_id and
    text are not read, nor those of ``labels`` beside doc_id and toxic.
    """
    index = index or fit(docs, labels, holdout, parts)
    return score(docs, index).select(
        "doc_id", F.coalesce(id_bucket(F.col("doc_id"), parts) == holdout, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence", "matched_terms",
    )
