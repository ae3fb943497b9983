"""Fill-in-middle, quality and source divergence against plain Python, and on awkward rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokoledger.llm import divergence, quality
from tokoledger.llm import fill_in_middle as fim
from tokoledger.llm.perfect_hash import PerfectHash

LONG = "Lorem ipsum, dolor 中文 é.\n" * 20000
AWKWARD = [
    (1, None, "en", None), (2, "", None, "s"), (3, LONG, "en", "s"), (4, "a b c d", "en", "t"), (4, "a b c d", "en", "t"), (4, "other", "en", "t"),
    (None, "a b c d", "en", "t"), (7, "A b\tC d<S>", "de", "t"), (8, " \n\t ", "en", "t"), (9, "12 34 !!", None, "t"), (None, None, None, None),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def awkward(spark):
    names = ("n", "form", "output", "shard", "slot", "term", "y", "label", "score", "value", "item", "block", "v")
    return spark.createDataFrame(AWKWARD, SCHEMA).withColumns({c: F.lit("x") for c in names})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- fill-in-middle ------------------------------------------------------------------------------
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def plain_fim(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = UNIT.findall(text)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text, text
    if h[3] % 100 < 20:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def fim_rows(df):
    back = fim.restored(F.col("output"), F.col("form")).alias("back")
    found = fim.fill_in_middle(df).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", back)
    return sorted(map(tuple, found.collect()), key=repr)


def test_fim_equals_plain_python(spark):
    rnd = random.Random(5)
    pieces = ["a", "Z", "bc", "é", "ß", "中", "😀", " ", "\n", "0", "<", "P", ">", "S", "M", "[", "`", "{", "@", "\x00", "́", "z", "A"]
    rows = [(k, "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 40)))) for k in range(1500)]
    rows += [(k, "<P" + ">" * (k % 2) + "x <<S") for k in range(40)]
    got = fim_rows(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == sorted((plain_fim(*r) for r in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_fim_awkward(awkward, empty):
    assert fim_rows(awkward) == sorted((plain_fim(i, t) for i, t, *_ in AWKWARD), key=repr)
    out = fim.fill_in_middle(awkward)
    assert set(out.columns) == set(awkward.columns) | {"prefix_chars", "middle_chars"} and len(out.columns) == len(set(out.columns))
    assert fim.fill_in_middle(empty).collect() == []


def test_word_marks_cross_words(monkeypatch):
    """Marks do not depend on how many words are taken at once."""
    text = ("ab1é中" * 50 + "zz").encode()
    data, stops = np.frombuffer(text, np.uint8), np.array([len(text)])
    whole = fim.Units(data, stops)
    monkeypatch.setattr(fim, "WORDS", 3)
    parts = fim.Units(data, stops)
    assert (whole.ends == parts.ends).all() and (whole.points == parts.points).all()
    ends = np.cumsum([len(u.encode()) for u in UNIT.findall(text.decode())])
    assert whole.after_end(np.arange(1, len(ends) + 1)).tolist() == ends.tolist()
    assert whole.ends_before(ends).tolist() == list(range(1, len(ends) + 1))


# ---- quality -------------------------------------------------------------------------------------
def test_features_equal_plain_python():
    texts = [None, "", "Ab ab Ab\n\nAb ab Ab\nAb ab x x | 12!é", "x"]
    got, n_lines, weight = quality.features(texts)
    want, weights = [], []
    for text in texts:
        before, seen = set(), set()
        for line in (text or "").split("\n"):
            raw, words = line.encode(), line.split()
            n, size, pairs = max(len(words), 1), max(len(raw), 1), list(zip(words, words[1:], strict=False))
            share = lambda chars: sum(c in chars for c in line) / size  # noqa: E731, B023
            letters = [c for c in line if c.isascii() and c.isalpha()]
            want.append([
                math.log1p(len(raw)), sum(c.isupper() for c in letters) / max(len(letters), 1), sum(ord(c) > 127 for c in line) / size, share("0123456789"),
                share("#$%&*+/<=>@[\\]^_`{}~"), share("!?"), share("|"), share(".,;:"), math.log1p(len(words)), sum(len(w.encode()) for w in words) / n,
                len(set(words)) / n if words else 1, len(set(pairs)) / len(pairs) if pairs else 1, sum(a == b for a, b in pairs) / max(len(pairs), 1),
                len(set(words) & before) / max(len(set(words)), 1), bool(words) and line in seen,
            ])
            weights.append(len(raw) + 1)
            before = set(words)
            seen.add(line)
    assert np.allclose(got, want) and n_lines.tolist() == [1, 1, 4, 1] and weight.tolist() == weights


def by_enumeration(logit, trans):
    n = len(logit)
    good, pair, total = np.zeros(n), np.zeros((2, 2, n)), 0.0
    for labels in itertools.product((0, 1), repeat=n):
        weight = math.exp(sum(logit[i] for i in range(n) if labels[i]) + sum(trans[labels[i - 1]][labels[i]] for i in range(1, n)))
        total += weight
        for i in range(n):
            good[i] += weight * labels[i]
            if i:
                pair[labels[i - 1], labels[i], i] += weight
    return good / total, pair / total, math.log(total)


def test_marginals_equal_enumeration():
    rnd = np.random.default_rng(3)
    trans = rnd.normal(size=(2, 2))
    lengths = [1, 5, 2, 9, 1, 3]
    logit = rnd.normal(size=sum(lengths)) * 3
    first = np.zeros(len(logit), bool)
    first[np.cumsum(lengths) - lengths] = True
    good, pair = quality.marginals(logit, trans, first)
    at = 0
    for n in lengths:
        want, pairs, _ = by_enumeration(logit[at : at + n], trans)
        assert np.allclose(good[at : at + n], want) and np.allclose(pair[:, :, at : at + n], pairs)
        at += n


def test_marginals_of_a_long_chain_stay_finite():
    logit = np.where(np.arange(100_000) % 3, 40.0, -60.0)
    good, _ = quality.marginals(logit, np.array([[2.0, -2.0], [-2.0, 2.0]]), np.arange(100_000) == 0)
    assert np.isfinite(good).all() and (good[1::3] > 0.5).all()


def test_gradient_equals_differences():
    rnd = np.random.default_rng(4)
    at = rnd.integers(0, quality.BINS, (9, 4))
    first = np.array([1, 0, 0, 1, 0, 0, 0, 0, 1], bool)
    label = np.array([1, 1, 1, 0, 0, 0, 0, 0, 1])
    share = np.repeat([0.3, 0.5, 0.2], [3, 5, 1])
    field = quality.Field([], rnd.normal(size=(4, quality.BINS + 1)), 0.2, rnd.normal(size=(2, 2)))

    def loss():
        value, starts = 0.0, [*np.flatnonzero(first), len(at)]
        logit = field.logits(at)
        for lo, hi in itertools.pairwise(starts):
            y = label[lo]
            value += share[lo] * (logit[lo:hi].sum() * y + (hi - lo - 1) * field.trans[y, y] - by_enumeration(logit[lo:hi], field.trans)[2])
        return value

    of_weights, of_bias, of_trans = quality.gradient(field, quality.places(at), label, share, first)
    for part, slopes in ((field.weights, of_weights), (field.trans, of_trans)):
        for place in np.ndindex(part.shape):
            kept = part[place]
            part[place] = kept + 1e-5
            up = loss()
            part[place] = kept - 1e-5
            down = loss()
            part[place] = kept
            assert abs((up - down) / 2e-5 - slopes[place]) < 1e-6
    field.bias += 1e-5
    up = loss()
    field.bias -= 2e-5
    assert abs((up - loss()) / 2e-5 - of_bias) < 1e-6


def test_score_is_the_weighted_mean_of_the_lines_marginals():
    texts = ["good line here.\n$$$ %%% ###\nanother good line", "$$$", None]
    values, _, weight = quality.features(texts)
    rnd = np.random.default_rng(5)
    field = quality.Field(quality.edges_of(values), rnd.normal(size=(45, quality.BINS + 1)), 0.1, rnd.normal(size=(2, 2)))
    at = 0
    for text, score in zip(texts, field.scores(texts), strict=True):
        n = len((text or "").split("\n"))
        bins = quality.binned(values[at : at + n], field.edges)
        logit = []
        for k in range(n):
            rows = [bins[k], bins[k - 1] if k else np.full(15, quality.BINS), bins[k + 1] if k + 1 < n else np.full(15, quality.BINS)]
            logit.append(sum(field.weights[f, b] for f, b in enumerate(np.concatenate(rows))) + field.bias)
        good, _, _ = by_enumeration(logit, field.trans)
        assert abs(score - np.average(good, weights=weight[at : at + n])) < 1e-9
        at += n


def test_quality_held_out(spark):
    root = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in found) >= 0.95 * len(found) > 0
    bad = [r for r in found if r.quality == 0]
    assert sum(r.predicted == 0 for r in bad) >= 0.8 * len(bad) > 0
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)


def test_quality_repeats(spark, small_sf):
    """The same rows in another order and number of partitions give the same scores."""
    docs, labels = (spark.read.parquet(f"{small_sf}/{t}.parquet") for t in ("documents", "labels"))
    one = {r.doc_id: r.score for r in quality.quality(docs, labels).collect()}
    two = {r.doc_id: r.score for r in quality.quality(docs.repartition(7).orderBy(F.desc("doc_id")), labels.repartition(3)).collect()}
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-6 for k in one)


def test_quality_awkward(spark, awkward, empty):
    labels = spark.createDataFrame([(3, 1, 0, "x"), (4, 0, 0, "x"), (8, 0, 0, "x"), (8, 1, 0, "x"), (9, None, 0, "x"), (None, 1, 0, "x"), (1, 5, 0, "x")], "doc_id long, quality int, toxic int, text string")
    rows = quality.quality(awkward, labels).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1      # null and empty alike
    prior = quality.quality(awkward, labels.limit(0)).collect()
    assert {r.score for r in prior} == {0.5}
    assert quality.quality(empty, labels).collect() == []


# ---- source divergence ---------------------------------------------------------------------------
def test_perfect_hash_is_minimal_and_verified():
    keys = [f"w{k}é".encode() for k in range(5000)] + [b"x" * 1000, b"y" * 1000]
    made = PerfectHash.loads(PerfectHash.build(keys).dumps())
    assert sorted(made.slots(keys).tolist()) == list(range(len(keys)))
    assert (made.slots([f"v{k}".encode() for k in range(20000)] + [b"x" * 999]) == -1).all()
    one = PerfectHash.build([b"a"])
    assert one.slots([b"a", b"b"]).tolist() == [0, -1]


def test_perfect_hash_with_equal_hashes(monkeypatch):
    from tokoledger.llm import perfect_hash

    monkeypatch.setattr(perfect_hash, "hashes", lambda keys: np.array([len(k) % 3 for k in keys], np.uint64))
    keys = [b"a", b"b", b"cc", b"dd", b"eee", b"fff", b"gggg"]
    made = PerfectHash.build(keys)
    assert sorted(made.slots(keys).tolist()) == list(range(7))
    assert made.slots([b"z", b"zz", b"zzz"]).tolist() == [-1, -1, -1]


TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_divergence(rows, least=3, most=200):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = defaultdict(Counter)
    counts = defaultdict(Counter)
    for text, lang, source in rows:
        words = [w.translate(lower) for w in TERM.findall(text or "")]
        counts[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    kept = {lang: sorted(w for w, n in found.items() if n >= least) for lang, found in docs.items()}
    langs = {lang for lang, _ in counts}
    vocabulary = {lang: kept.get(lang, []) for lang in langs}

    def shares(found, words):
        total = sum(found[w] for w in words) + len(words)
        return {w: 1 + 10**9 * (found[w] + 1) // total for w in words}

    out = []
    for (lang, source), found in counts.items():
        words = vocabulary[lang]
        p = shares(found, words)
        whole = sum((c for (other, _), c in counts.items() if other == lang), Counter())
        q = shares(whole, words)
        pair = []
        for other_lang, other in counts:
            if other_lang == lang and other != source:
                t = shares(counts[lang, other], words)
                pair.append((other, sum((p[w] - t[w]) ** 2 // t[w] for w in words)))
        term = [(w, (p[w] - q[w]) ** 2 // q[w]) for w in words if found[w] and p[w] > q[w]]
        for part, items, limit in (("pair", pair, None), ("term", term, most)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return sorted(out)


def divergence_rows(df, **more):
    return sorted(map(tuple, divergence.source_divergence(df, **more).select("lang", "source", "part", "item", "value", "rank").collect()))


@pytest.fixture(scope="module")
def spoken(spark):
    rnd = random.Random(6)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)] + ["É中文", "中", "É", "é", "x" * 100]
    rows = []
    for _ in range(400):
        lang = rnd.choice(["en", "de", None])
        source = rnd.choice(["a", "b", "c", "", None, "d"])
        text = " ".join(rnd.choice(words[: rnd.choice([20, 305])]) for _ in range(rnd.randint(0, 60)))
        rows.append((text.title() if rnd.random() < 0.2 else text, lang, source))
    rows += [("only here", "fr", "a"), (None, "fr", "b"), ("only here", "it", "a")]
    return rows, spark.createDataFrame(rows, "text string, lang string, source string")


def test_divergence_equals_plain_python(spoken):
    rows, df = spoken
    assert divergence_rows(df) == plain_divergence(rows)


def test_divergence_in_many_shards_waves_and_blocks(spoken, monkeypatch):
    rows, df = spoken
    for name, value in (("SHARD", 16), ("CELLS", 64), ("BLOCK", 20), ("HELD", 50), ("TOGETHER", 9), ("REMEMBERED", 30)):
        monkeypatch.setattr(divergence, name, value)
    assert divergence_rows(df, wave_bytes=1000, most=7) == plain_divergence(rows, most=7)


def test_terms_in_pieces():
    text = "Ab cd, éF gh" * 50
    assert [t for part in divergence.terms(text, 7) for t in part] == [t.encode() for t in TERM.findall(text.lower())]


def test_recount_looks_each_distinct_term_up_once(monkeypatch):
    made = PerfectHash.build([b"ab", b"cd", "\u00e9f".encode()])
    count = divergence._Recount([("en", 0, made.dumps())], 1)
    asked = []
    look_up = count._look_up
    monkeypatch.setattr(count, "_look_up", lambda lang, keys: asked.extend(keys) or look_up(lang, keys))
    texts = [b"  ab cd ab xx ", b"", " \u00e9f ab".encode() * 50, b"ab" * 9, b"ab cd"]
    lang, source = np.array([0, 0, 0, 1, 0]), np.array([0, 1, 1, 0, 0])
    for _ in range(2):
        count.add(texts, lang, ["en", "de"], source, ["a", "b"])
    assert sorted(asked) == [b"ab", b"cd", b"xx", "\u00e9f".encode()]
    slots = made.slots([b"ab", b"cd", "\u00e9f".encode()])
    assert count.dense["en", "a"][slots].tolist() == [6, 4, 0] and count.dense["en", "b"][slots].tolist() == [100, 0, 100]
    assert ("de", "a") not in count.dense
    packed = [x for x in count.out() for _ in range(2)]                # as from two tasks
    assert sum(map(len, packed)) == 4
    summed = {(r["source"], r["slot"]): r["n"] for x in divergence._added(packed) for r in x.to_pylist()}
    assert summed == {("a", slots[0]): 12, ("a", slots[1]): 8, ("b", slots[0]): 200, ("b", slots[2]): 200}


def test_recount_never_holds_more_counters_than_it_may(monkeypatch):
    words = [b"a" + bytes([97 + k % 26, 97 + k // 26]) for k in range(100)]
    sources = [f"s{k}" for k in range(30)]
    monkeypatch.setattr(divergence, "CELLS", 1000)
    count = divergence._Recount([("en", 0, PerfectHash.build(words).dumps())], 1)
    texts = [b" ".join(words[: 3 * k + 1]) for k in range(30)]
    out = []
    for _ in range(3):
        count.add(texts, np.zeros(30, np.int64), ["en"], np.arange(30), sources)
        assert sum(x.nbytes for x in count.dense.values()) <= 4 * 1000
        out += count.taken()
    out += count.out()
    summed = Counter()
    for x in out:
        for source, slots, n in zip(*(x.column(k).to_pylist() for k in (1, 3, 4)), strict=True):
            assert len(slots) == len(n)
            summed[source] += int(np.frombuffer(n, "<i4").sum())
    assert summed == {f"s{k}": 3 * (3 * k + 1) for k in range(30)}


def test_recount_of_more_than_32_bits(monkeypatch):
    made = PerfectHash.build([b"ab"])
    monkeypatch.setattr(divergence, "COUNTED", (1 << 31) - 9)
    count = divergence._Recount([("en", 0, made.dumps())], 1)
    out = []
    for _ in range(3):
        count.add([b"ab ab"], np.zeros(1, np.int64), ["en"], np.zeros(1, np.int64), ["s"])
        count.dense["en", "s"][0] = count.counted = (1 << 31) - 10      # as after so many occurrences
        count.add([b"ab ab"], np.zeros(1, np.int64), ["en"], np.zeros(1, np.int64), ["s"])
        out += count.taken()
        assert not count.dense
    assert [r["n"] for x in divergence._added(out) for r in x.to_pylist()] == [3 * ((1 << 31) - 8)]


def test_divergence_stores_and_keeps_only_what_its_result_reads(spark, spoken, monkeypatch):
    rows, df = spoken
    stored, made = divergence.stored, []
    monkeypatch.setattr(divergence, "stored", lambda x: made.append(x.columns) or stored(x))
    kept = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    before = kept()
    assert divergence_rows(df, wave_bytes=1000) == plain_divergence(rows)
    assert kept() == before
    assert made == [["lang", "shard", "slot", "term", "hash"], ["lang", "source", "n", "v"], ["lang", "shard", "source", "other", "slot", "value"]]


def test_divergence_awkward(awkward, empty):
    assert divergence_rows(awkward) == plain_divergence([r[1:] for r in AWKWARD])
    assert divergence_rows(empty) == []


def test_share_is_exact_for_large_counts():
    counts = [0, 1, 9_000_000_000, 4 * 10**14, 8 * 10**15]
    total = 9 * 10**15
    assert divergence.share(np.array(counts), total).tolist() == [1 + 10**9 * (c + 1) // total for c in counts]
