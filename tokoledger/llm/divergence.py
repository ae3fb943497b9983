"""Source divergence audit: where the vocabulary of a source differs from the other
sources of its language.

1. Exact frequency filter: documents per (language, term), counted whole, keep the terms
   that enough documents have.
2. The kept terms of a language are dealt into shards by hash; each shard becomes a
   minimal perfect hash with its keys stored.
3. Recount: shards are broadcast in waves of a bounded size; a task turns the terms of
   its documents into slots and adds to a dense array for each (language, source, shard).
4. Shares and divergences over blocks of slots with all sources of the language beside
   each other, in integers.

A term is a run of ASCII letters and non-ASCII code points with A-Z lower-cased. Null text,
lang and source count as ''. Rows repeat as often as they are given; ids do not matter.
A language without kept terms has divergences of 0. An empty table gives no rows.
Columns other than text, lang and source are ignored.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokoledger.llm.common import held, in_arrow, ship, stored
from tokoledger.llm.perfect_hash import PerfectHash, hashes
from tokoledger.llm.pretokens import gathered, runs
from tokoledger.plans.joins import bounded_broadcast

SHARD = 1 << 14              # terms in a shard, about
WAVE = 32 << 20              # bytes of perfect hashes that are broadcast together
CELLS = 1 << 24              # dense counters that a task holds
COUNTED = 1 << 30            # occurrences in them; with those of one part more a counter of 32 bits is enough
BLOCK = 1 << 19              # counts (sources x slots) that are compared together
HELD = 400_000               # document frequencies that a task holds
TOGETHER = 8_000_000         # bytes of text whose distinct terms are found together
REMEMBERED = 400_000         # terms whose slots a task remembers, of all languages
HELD_BYTES = 64 << 20        # and bytes of the documents' distinct terms behind them
SCALE = 1_000_000_000

_UPPER = range(ord("A"), ord("Z") + 1)
#: Bytes of terms, lower-cased; all others become spaces.
_TERM_BYTES = bytes(c + 32 if c in _UPPER else c if c >= 128 or ord("a") <= c <= ord("z") else 32 for c in range(256))


def _pieces(text: bytes, size: int):
    """A text's terms with blanks between them, in pieces of about ``size`` bytes."""
    data, at = text.translate(_TERM_BYTES), 0
    while at < len(data):
        end = data.find(b" ", at + size) if len(data) > at + size else -1
        end = len(data) if end < 0 else end
        yield data[at:end]
        at = end


def terms(text: str, size: int = 1 << 20):
    """The terms of a text, in lists of about ``size`` bytes of text."""
    for piece in _pieces(text.encode(), size):
        yield piece.split()


def _names(column: pa.Array) -> pa.DictionaryArray:
    return pc.fill_null(column.cast(pa.string()), "").dictionary_encode()


def _coded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """For each term of pieces of text, the number of its text and of the term; and the distinct terms."""
    lists = pc.split_pattern(pa.array(texts, pa.large_binary()), b" ")
    coded = lists.values.dictionary_encode()
    code, distinct = coded.indices.to_numpy(), coded.dictionary
    which = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
    del lists
    real = (pc.binary_length(distinct).to_numpy() > 0)[code]      # what stands between two blanks is empty
    return which[real], code[real], distinct.to_pylist()


def _sorted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order and how often each occurs; for many values sorting takes less time than ``np.unique``."""
    values = np.sort(values)
    begin = np.flatnonzero(np.diff(values, prepend=values[:1] - 1))
    return values[begin], np.diff(begin, append=len(values))


def _parts(batches):
    """Arrow batches of about ``TOGETHER`` bytes of text, and their texts in bytes."""
    for part in gathered(batches, 0, TOGETHER):
        yield part, pc.fill_null(part.column(0).cast(pa.large_binary()), b"").to_pylist()


def _rows(batch, size: int = 2_000_000):
    """(text, lang, source) in runs of about ``size`` bytes of text."""
    for part in runs(batch, 0, size):
        yield zip(*(["" if x is None else x for x in part.column(k).to_pylist()] for k in range(3)), strict=True)


def _document_frequencies(batches):
    held: dict[str, Counter] = {}
    size = 0

    def out():
        for lang, found in held.items():
            columns = [pa.repeat(pa.scalar(lang, pa.string()), len(found)), pa.array(list(found), pa.binary()).cast(pa.string()), pa.array(list(found.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "term", "n_docs"])
        held.clear()

    for batch in batches:
        for rows in _rows(batch):
            for text, lang, _ in rows:
                found = set().union(*terms(text))
                held.setdefault(lang, Counter()).update(found)
                size += sum(map(len, found))
                if size > HELD_BYTES or sum(map(len, held.values())) > HELD:
                    yield from out()
                    size = 0
    yield from out()


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    """One shard: a row with its perfect hash, and the slot of each term."""
    keys = [t.encode() for t in pdf["term"]]
    made = PerfectHash.build(keys)
    lang, shard = pdf["lang"].iloc[0], pdf["shard"].iloc[0]
    rows = pd.DataFrame({"lang": lang, "shard": shard, "slot": made.slots(keys), "term": pdf["term"].to_numpy(), "hash": None})
    return pd.concat([pd.DataFrame([{"lang": lang, "shard": shard, "slot": -1, "term": None, "hash": made.dumps()}]), rows])


class _Recount:
    """Dense counters of a task for the shards of one wave: one array for each (language, source),
    with the slots of the language's shards behind each other."""

    def __init__(self, wave: list[tuple[str, int, bytes]], parts: int):
        self.parts = parts
        self.shards: dict[str, dict[int, PerfectHash]] = {}
        for lang, shard, blob in wave:
            self.shards.setdefault(lang, {})[shard] = PerfectHash.loads(blob)
        self.begin = {lang: np.concatenate(([0], np.cumsum([len(made) for made in mine.values()]))) for lang, mine in self.shards.items()}
        self.known: dict[str, dict[bytes, int]] = {lang: {} for lang in self.shards}
        self.dense: dict[tuple[str, str], np.ndarray] = {}
        self.cells = self.counted = 0
        self.ready: list[pa.RecordBatch] = []

    def _look_up(self, lang: str, keys: list[bytes]) -> np.ndarray:
        """Places of terms in the language's arrays, -1 for terms that are not kept or not in this wave."""
        place, h = np.full(len(keys), -1, np.int64), hashes(keys)
        shard = np.mod(h.view(np.int64), self.parts)
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], [[s, s + 1] for s in self.shards[lang]])
        for begin, made, (lo, hi) in zip(self.begin[lang], self.shards[lang].values(), bounds, strict=False):
            at = order[lo:hi]
            slot = made.slots([keys[i] for i in at], h[at])
            place[at] = np.where(slot >= 0, begin + slot, -1)
        return place

    def _places(self, lang: str, keys: list[bytes]) -> np.ndarray:
        """As ``_look_up``; places are remembered."""
        known = self.known[lang]
        missing = [k for k in keys if k not in known]
        known.update(zip(missing, self._look_up(lang, missing).tolist(), strict=True))
        place = np.fromiter(map(known.__getitem__, keys), np.int64, len(keys))
        if sum(map(len, self.known.values())) > REMEMBERED:
            for word in missing:
                del known[word]
        return place

    def add(self, texts: list[bytes], lang: np.ndarray, langs: list[str], source: np.ndarray, sources: list[str]) -> None:
        """Count the terms of pieces of text; ``lang`` and ``source``: the number of each text's name."""
        which, code, distinct = _coded(texts)
        each = max(1, len(distinct))
        group = lang * len(sources) + source
        found, n = _sorted(group[which] * each + code)
        del which, code
        group, code = np.divmod(found, each)
        for k in np.unique(group // len(sources)).tolist():
            if langs[k] not in self.shards:
                continue
            begin, end = np.searchsorted(group, [k * len(sources), (k + 1) * len(sources)])
            mine, at = np.unique(code[begin:end], return_inverse=True)
            place = self._places(langs[k], [distinct[i] for i in mine.tolist()])[at]
            for g in np.unique(group[begin:end]).tolist():
                a, b = np.searchsorted(group, [g, g + 1])
                to, counted = place[a - begin:b - begin], n[a:b]
                self._counters(langs[k], sources[g % len(sources)])[to[to >= 0]] += counted[to >= 0]     # a term has one place
                self.counted += int(counted.sum())
        if self.counted > COUNTED:
            self.ready.extend(self.out())

    def _counters(self, lang: str, source: str) -> np.ndarray:
        """Those of a language and source; where they would be too many with the others, these become ready before."""
        if (lang, source) not in self.dense:
            new = int(self.begin[lang][-1])
            if self.dense and self.cells + new > CELLS:
                self.ready.extend(self.out())
            self.dense[lang, source] = np.zeros(new, np.int32)
            self.cells += new
        return self.dense[lang, source]

    def taken(self):
        """What is ready."""
        yield from self.ready
        self.ready.clear()

    def out(self):
        """A row for each (lang, source, shard), with the slots that were counted and their counts in bytes."""
        for (lang, source), counts in self.dense.items():
            rows, begin = [], self.begin[lang].tolist()
            for shard, a, b in zip(self.shards[lang], begin[:-1], begin[1:]):
                slot = np.flatnonzero(counts[a:b])
                if len(slot):
                    rows.append((lang, source, shard, slot.astype("<i4").tobytes(), counts[a:b][slot].astype("<i4").tobytes()))
            if rows:
                columns = [pa.array(x, kind) for x, kind in zip(zip(*rows), (pa.string(), pa.string(), pa.int64(), pa.binary(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "shard", "slots", "counts"])
        self.dense.clear()
        self.cells = self.counted = 0


def _added(batches):
    """Sums of what ``_Recount.out`` gave, in order of lang, source and shard: a row for each slot."""
    last, total = None, np.zeros(0, np.int64)

    def out():
        slot = np.flatnonzero(total)
        if len(slot):
            names = [pa.repeat(pa.scalar(x, kind), len(slot)) for x, kind in zip(last, (pa.string(), pa.string(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*names, pa.array(slot, pa.int64()), pa.array(total[slot], pa.int64())], ["lang", "source", "shard", "slot", "n"])

    for batch in batches:
        for i, key in enumerate(zip(*(batch.column(k).to_pylist() for k in range(3)))):
            slot, n = (np.frombuffer(batch.column(k)[i].as_buffer(), kind) for k, kind in ((3, "<i4"), (4, "<i4")))
            if key != last:
                yield from out()
                last, total = key, np.zeros(0, np.int64)
            if slot[-1] >= len(total):
                total = np.concatenate([total, np.zeros(slot[-1] + 1 - len(total), np.int64)])
            total[slot] += n
    yield from out()


def _recount(docs: DataFrame, wave: list, parts: int) -> DataFrame:
    """Occurrences of the wave's terms per (lang, source, shard, slot)."""
    sent = docs.sparkSession.sparkContext.broadcast(wave)

    def run(batches):
        count = None
        for part, texts in _parts(batches):
            count = _Recount(sent.value, parts) if count is None else count
            names = [_names(part.column(k)) for k in (1, 2)]
            (lang, langs), (source, sources) = ((x.indices.to_numpy().astype(np.int64), x.dictionary.to_pylist()) for x in names)
            for pieces in _pieces(texts[0], TOGETHER) if len(texts) == 1 else [None]:
                count.add([t.translate(_TERM_BYTES) for t in texts] if pieces is None else [pieces], lang, langs, source, sources)
                yield from count.taken()
        if count:
            yield from count.out()

    keys = ["lang", "source", "shard"]
    found = in_arrow(docs, run, "lang string, source string, shard long, slots binary, counts binary")
    return in_arrow(found.repartition(*keys).sortWithinPartitions(*keys), _added, "lang string, source string, shard long, slot long, n long")


def share(count: np.ndarray, total) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total) in 64-bit integers: a long division by 1000 at a
    time, right for totals to 9 * 10**15."""
    rest, out = np.asarray(count, np.int64) + 1, 0
    out, rest = rest // total, rest % total
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return 1 + out


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _compare(most: int):
    """Partial results of one block of slots: the pair sums of its slots, and for each source
    the terms that can be among its ``most`` first ones, ties included."""

    def run(key, counts: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
        names = sorted(sources["source"])
        info = sources.set_index("source").loc[names]
        total = (info["n"] + info["v"]).to_numpy(np.int64)[:, None]
        slots, at = np.unique(counts["slot"].to_numpy(), return_inverse=True)
        c = np.zeros((len(names), len(slots)), np.int64)
        c[pd.Index(names).get_indexer(counts["source"]), at] = counts["n"].to_numpy()
        p = share(c, total)
        q = share(c.sum(0), int(info["n"].sum() + info["v"].iloc[0]))
        out = []
        for k, name in enumerate(names):
            if len(names) > 1:
                value = divergence(p[k], p).sum(1)
                out.append(pd.DataFrame({"source": name, "other": names, "slot": -1, "value": value}).drop(index=k))
            over = np.flatnonzero((c[k] > 0) & (p[k] > q))
            f = divergence(p[k][over], q[over])
            if len(over) > most:
                keep = f >= np.partition(f, len(f) - most)[len(f) - most]
                over, f = over[keep], f[keep]
            out.append(pd.DataFrame({"source": name, "other": None, "slot": slots[over], "value": f}))
        found = pd.concat(out, ignore_index=True)
        found.insert(0, "lang", key[0])
        found.insert(1, "shard", key[1])
        return found[["lang", "shard", "source", "other", "slot", "value"]]

    return run


def kept_terms(docs: DataFrame, least: int) -> tuple[DataFrame, int]:
    """(lang, shard, slot, term) of the terms in at least ``least`` documents, and one row per shard with its
    perfect hash (slot -1), stored; and the number of parts that every language's terms are dealt into."""
    frequent = in_arrow(docs, _document_frequencies, "lang string, term string, n_docs long")
    frequent = held(frequent.groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs")).where(F.col("n_docs") >= least).select("lang", "term"))
    parts = max(1, -(-frequent.count() // SHARD))
    dealt = frequent.withColumn("shard", F.pmod(F.xxhash64("term"), F.lit(parts)))
    built = stored(dealt.groupBy("lang", "shard").applyInPandas(_build, "lang string, shard long, slot long, term string, hash binary"))
    frequent.unpersist()
    return built, parts


def _waves(built: DataFrame, most: int):
    """Lists of (lang, shard, hash) of about ``most`` bytes; the driver holds one at a time."""
    wave, held = [], 0
    for row in built.where("slot = -1").select("lang", "shard", "hash").toLocalIterator():
        wave.append((row.lang, row.shard, bytes(row.hash)))
        held += len(row.hash)
        if held >= most:
            yield wave
            wave, held = [], 0
    if wave:
        yield wave


def recount(docs: DataFrame, built: DataFrame, parts: int, wave_bytes: int = WAVE) -> list[DataFrame]:
    """(lang, source, shard, slot, n) of each wave: one pass over the documents, held."""
    return [held(_recount(docs, wave, parts)) for wave in _waves(built, wave_bytes)]


def source_divergence(documents: DataFrame, least: int = 3, most: int = 200, wave_bytes: int = WAVE) -> DataFrame:
    """``(lang, source, part, item, value, rank)``; see the module. ``least``: documents that a kept
    term has; ``most``: ranks of the part ``term``; ``wave_bytes``: bytes broadcast at once."""
    ship(documents.sparkSession)
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    docs = documents.select(*text)
    built, parts = kept_terms(docs, least)
    counted = recount(docs, built, parts, wave_bytes)
    none = docs.sparkSession.createDataFrame([], "lang string, source string, shard long, slot long, n long")
    counts = reduce(DataFrame.unionByName, counted or [none])
    size = built.where("slot >= 0").groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    total = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = docs.select("lang", "source").distinct().join(total, ["lang", "source"], "left").join(size, "lang", "left")
    groups = stored(groups.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v")))

    most_sources = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("s")).agg(F.max("s")).first()[0] or 1
    width = max(1, BLOCK // most_sources)
    block = F.floor(F.col("slot") / width).alias("block")
    blocks = built.where("slot >= 0").select("lang", "shard", block).distinct()
    left = counts.select("lang", "shard", block, "source", "slot", "n")
    right = blocks.join(bounded_broadcast(groups), "lang")
    keys = ["lang", "shard", "block"]
    found = stored(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        _compare(most), "lang string, shard long, source string, other string, slot long, value long"))
    for part in counted:
        part.unpersist()

    sums = found.where("other IS NOT NULL").groupBy("lang", "source", F.col("other").alias("item")).agg(F.sum("value").alias("value"))
    others = groups.select("lang", F.col("source").alias("item"))
    pairs = groups.select("lang", "source").join(others, "lang").where("source <> item").join(sums, ["lang", "source", "item"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    words = built.where("slot >= 0").select("lang", "shard", "slot", F.col("term").alias("item"))
    over = found.where("other IS NULL").join(words, ["lang", "shard", "slot"])
    over = over.select("lang", "source", F.lit("term").alias("part"), "item", "value")

    by = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(by).alias("rank")
    return pairs.select("*", rank).unionByName(over.select("*", rank).where(F.col("rank") <= most))


ORACLE = """
WITH docs AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words FROM documents),
grp AS (SELECT DISTINCT lang, source FROM docs),
occurrence AS (SELECT k, lang, source, unnest(words) AS term FROM docs),
kept AS (SELECT lang, term FROM occurrence GROUP BY lang, term HAVING count(DISTINCT k) >= 3),
vocabulary AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counted AS (SELECT lang, source, term, count(*) AS n FROM occurrence SEMI JOIN kept USING (lang, term) GROUP BY ALL),
dense AS (
  SELECT g.lang, g.source, w.term, coalesce(c.n, 0)::HUGEINT AS n
  FROM grp g JOIN kept w ON w.lang = g.lang LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = w.term),
shares AS (
  SELECT lang, source, term, n, 1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER (PARTITION BY lang, source)::HUGEINT + v) AS p
  FROM dense JOIN vocabulary USING (lang)),
whole AS (
  SELECT lang, term, 1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER (PARTITION BY lang)::HUGEINT + v) AS q
  FROM (SELECT lang, term, sum(n)::HUGEINT AS n FROM dense GROUP BY lang, term) JOIN vocabulary USING (lang)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum((s.p - t.p) * (s.p - t.p) // t.p), 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares s ON s.lang = a.lang AND s.source = a.source
  LEFT JOIN shares t ON t.lang = b.lang AND t.source = b.source AND t.term = s.term
  GROUP BY a.lang, a.source, b.source),
term AS (
  SELECT s.lang, s.source, s.term AS item, (s.p - w.q) * (s.p - w.q) // w.q AS value
  FROM shares s JOIN whole w ON w.lang = s.lang AND w.term = s.term WHERE s.n > 0 AND s.p > w.q),
found AS (SELECT lang, source, 'pair' AS part, item, value FROM pair UNION ALL SELECT lang, source, 'term', item, value FROM term)
SELECT lang, source, part, item, value::BIGINT AS value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM found QUALIFY part = 'pair' OR rank <= 200
"""
