"""The training-data operators against plain Python, and on awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import sys
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from tokenizers import Tokenizer, models, pre_tokenizers

from tokoledger.llm import bpe, common, langid, license_digest, packing, pivots, segments, simhash, token_count, toxicity, url_reputation
from tokoledger.llm import components as components_of_links
from tokoledger.llm.common import stored
from tokoledger.llm.components import components

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LONG = "lorem ipsum dolor " * 3000

# null, empty, very long, repeated and id-less rows; extra columns with names that the operators use themselves
AWKWARD = [
    (1, None, "en", "fp"), (2, "", None, "fp"), (3, LONG, "en", None), (4, "a b c d", "en", "x"), (4, "a b c d", "en", "x"),
    (None, "a b c d", "en", "x"), (7, "A b\tC d", "de", "x"), (8, " \n\t ", "en", "x"), (9, "12 34 !!", None, "x"), (None, None, None, None),
]
SCHEMA = "doc_id long, text string, lang string, fp string"


@pytest.fixture(scope="module")
def awkward(spark):
    from pyspark.sql import functions as F

    return spark.createDataFrame(AWKWARD, SCHEMA).withColumns({c: F.lit(1) for c in ("node", "root", "component_id", "score", "digest", "n_tokens")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, small_sf):
    return spark.read.parquet(f"{small_sf}/documents.parquet")


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_simhash_equals_brute_force(docs):
    rows = simhash.simhash_near_dedup(docs, subtree=16).collect()  # small subtrees: many pairs of them
    texts = {r.doc_id: r.text for r in docs.collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{p:016x}" for i, p in prints.items()}
    ids = sorted(prints)
    roots = plain_components(len(ids), lambda i, j: bin(prints[ids[i]] ^ prints[ids[j]]).count("1") <= 2)
    assert {r.doc_id: r.component_id for r in rows} == {ids[i]: ids[k] for i, k in enumerate(roots)}


def test_trie_pairs_in_a_dense_cluster():
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(200)}
    center = rng.getrandbits(64)
    prints |= {center ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(300)}
    a = np.array(sorted(prints), dtype=np.uint64)
    found = {(int(i), int(j)) for x, y in simhash.trie_pairs(a, a, 2, True) for i, j in zip(x, y)}
    assert found == {(i, j) for j in range(len(a)) for i in range(j) if int(np.bitwise_count(a[i] ^ a[j])) <= 2}


def test_trie_cut_goes_deeper_where_a_subtree_is_heavy(spark):
    values = sorted({(1 << 40) ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(12)} | {k << 50 for k in range(60)})
    classes = spark.createDataFrame([(v,) for v in values], "fp long")
    found = {(min(r), max(r)) for r in simhash.trie_links(classes, 2, subtree=4).collect()}
    assert found == {(x, y) for x in values for y in values if x < y and bin(x ^ y).count("1") <= 2}


def test_simhash_on_awkward_rows(awkward, empty):
    rows = simhash.simhash_near_dedup(awkward).collect()
    assert len(rows) == len(AWKWARD)
    by_id = {r.doc_id: r for r in rows if r.doc_id}
    assert {i for i, r in by_id.items() if r.fingerprint == "0" * 16} == {1, 2, 8} and by_id[8].component_id == 1
    assert by_id[7].component_id == 4 and {r.component_id for r in rows if r.doc_id is None} == {4, 1}
    kept = [r.doc_id for r in simhash.keep_one_per_group(awkward).collect()]
    assert sorted(kept, key=str) == [1, 3, 4, 9]
    assert simhash.simhash_near_dedup(empty).count() == 0 and simhash.keep_one_per_group(empty).count() == 0


def test_one_row_of_each_group_stays_whatever_the_ids(spark):
    """Against brute force: repeated ids with different texts, and copies without an id."""
    rng = random.Random(8)
    texts = [" ".join(rng.choices("abcdefghij", k=40)) for _ in range(12)] + ["", None]
    rows = [(rng.choice([None, 5, 5, 6, 7, 8]), rng.choice(texts), k) for k in range(120)] + [(5, "only once a b c d e f", 200), (5, "another one x y z u v w", 201)]
    kept = simhash.keep_one_per_group(spark.createDataFrame(rows, "doc_id long, text string, node int")).collect()
    prints = [plain_fingerprint(t) for _, t, _ in rows]
    classes = sorted(set(prints))
    root = {f: f for f in classes}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a in classes:
        for b in classes:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    groups = {}
    for (i, t, _), f in zip(rows, prints):
        signed = f - (1 << 64) if f >> 63 else f
        key = (i is None, i or 0, signed, hashlib.sha256(t.encode()).hexdigest() if t is not None else "")
        groups.setdefault(find(f), []).append((key, i, t))
    want = sorted((str(i), str(t)) for _, i, t in (min(g, key=lambda x: x[0]) for g in groups.values()))
    assert sorted((str(r.doc_id), str(r.text)) for r in kept) == want and len(kept) == len(groups)


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, 200 + i) for i in range(50)] + [(9, 9)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "u long, v long")).collect()))
    assert found == {i: 100 for i in range(100, 161)} | {7: 7} | {200 + i: 7 for i in range(50)}


def test_links_of_a_task_become_forests_of_the_same_classes(spark, monkeypatch):
    """... in the Python function that finds them: a second one behind it would double the workers of each core."""
    rng = random.Random(3)
    values = [0, *(rng.getrandbits(62) for _ in range(40))]
    values = sorted({v ^ (1 << a) ^ (1 << b) for v in values for a in range(6) for b in range(6)})
    classes = spark.createDataFrame([(v,) for v in values], "fp long")
    monkeypatch.setattr(simhash, "LINKS", 64)
    links = [tuple(r) for r in simhash.trie_links(classes, 2, subtree=32).collect()]
    forests = simhash.trie_links(classes, 2, subtree=32, forests=True)
    few = [tuple(r) for r in forests.collect()]
    assert len(few) < len(links) == len(set(links))
    want = dict(map(tuple, components(spark.createDataFrame(links, "u long, v long")).collect()))
    assert want and dict(map(tuple, components(forests, shrunk=True).collect())) == want

    plans = []

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df)

    monkeypatch.setattr(components_of_links, "stored", watched)
    docs = spark.createDataFrame([(i, f"a b c d e f g{i % 3}") for i in range(9)], "doc_id long, text string")
    assert simhash.simhash_near_dedup(docs).count() == 9 and simhash.keep_one_per_group(docs).count()
    assert len(plans) >= 2 and max(p.count("MapInArrow") for p in plans) == 1


def test_workers_forget_what_another_operator_left(spark):
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(20)], "doc_id long, text string").coalesce(1)
    left = packing._encoder(JSON, public_tokenizers.PATTERN, 1000, 0)
    assert packing._encoder(JSON, public_tokenizers.PATTERN, 1000, 0) is left
    common.forget_others(packing.__name__)
    assert packing._encoder(JSON, public_tokenizers.PATTERN, 1000, 0) is left
    common.forget_others(langid.__name__)
    assert not common._of_worker

    def held(batches):
        from tokoledger.llm import common, packing

        kept = len({**getattr(packing, "_of_worker", {}), **common._of_worker})
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([kept] * batch.num_rows, pa.int64())], ["kept"])

    assert packing.pack(docs, JSON, public_tokenizers.PATTERN).count() >= 20
    assert {r.kept for r in common.in_arrow(docs.select("doc_id"), held, "kept long").collect()} == {0}


def test_url_rules_and_reputation(spark):
    urls = [
        "http://WWW.Example.com/en/1", "https://a.example.com/en/2", "http://b.org/x?y", "x://net/es/", "http://a.net/fr/1#z", "nourl", None, "", "http://u@b.org:80/x",
        "http://example.com", "https://bad.org/1",
    ]
    pages = spark.createDataFrame([(i, u, "rate") for i, u in enumerate(urls)] + [(100 + i, "https://bad.org/p", "") for i in range(60)] + [(200 + i, "https://good.org/p", "") for i in range(60)] + [(None, "http://b.org/", "")], "page_id long, url string, rate string")
    labels = spark.createDataFrame([(100 + i, 0, 1) for i in range(60)] + [(200 + i, 1, 0) for i in range(60)] + [(2, 1, 0), (2, 1, 0), (5, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    rows = url_reputation.url_reputation(pages, labels).collect()
    got = {r.page_id: r for r in rows}
    assert len(rows) == len(urls) + 121
    assert [got[i].rule for i in range(5)] == ["www.example.com/en/", "example.com/en/", None, "net/es/", "net/fr/"]
    assert [got[i].verdict for i in (0, 1, 3, 4)] == ["allow", "block", "block", "block"]
    assert (got[5].host, got[5].path, got[6].host, got[9].rule, got[9].path) == ("", "", "", None, "")
    assert got[10].verdict == got[100].verdict == "block" and got[200].verdict == "allow" and got[10].bad_rate > got[8].bad_rate
    none = url_reputation.url_reputation(pages, labels.limit(0)).collect()
    assert {r.bad_rate for r in none} == {0.5} and url_reputation.url_reputation(pages.limit(0), labels).count() == 0


def test_license_digests(spark, awkward, empty):
    mit = license_digest.KNOWN["MIT"][0]
    texts = [mit.upper(), "Copyright (c) 2020 A\n  (C) B\n" + mit.replace(",", " ;").replace("sublicense", "sub-licence"), mit + " more", "released under THE mit licence", None, ""]
    rows = license_digest.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.license_id for r in rows} == {0: "MIT", 1: "MIT", 2: None, 3: "MIT", 4: None, 5: None}
    assert license_digest.license_scan(awkward).count() == len(AWKWARD) and license_digest.license_scan(empty).count() == 0


def test_whole_license_texts_and_titles(spark):
    from pathlib import Path

    whole = {p.stem: p.read_text() for p in (Path(license_digest.__file__).parent / "licenses").glob("*.txt")}
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "Unlicense"} <= whole.keys()
    texts = list(whole.items()) + [(k, whole[k][:whole[k].index("END OF TERMS")]) for k in ("Apache-2.0", "GPL-3.0")]
    texts += [
        (k, f"{title}\n\nCopyright (c) 2020 A\n\n{license_digest.KNOWN[k][0]}")
        for k, title in (("ISC", "ISC License"), ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"), ("Zlib", "zlib License"), ("Unlicense", "The Unlicense"))
    ]
    rows = license_digest.license_scan(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string")).collect()
    assert {r.doc_id: r.license_id for r in rows} == {i: k for i, (k, _) in enumerate(texts)}


def test_licenses_wrapped_at_any_width(spark, tmp_path):
    import textwrap

    import duckdb

    def wrapped(text, width, mark=""):
        parts = re.split(r"\n[ \t]*\n", text)
        return f"\n{mark.rstrip()}\n".join(textwrap.fill(p, width, initial_indent=mark, subsequent_indent=mark, break_long_words=False) for p in parts)

    notices = ["Copyright (c) 2020 A", "Copyright 2020-2024 A <a@b.org>\nCopyright © 2021 B", "(c) 2019 C\n(c) D", "Copyright The A Authors"]
    cases = []
    for k, texts in license_digest.KNOWN.items():
        for text in texts[:3]:
            cases += [(k, wrapped(text, width)) for width in (36, 50, 65, 72, 79, 100)]
            cases += [(k, f"{mark}{mark.join(n.splitlines(True))}\n{mark}\n{wrapped(text, 72, mark)}") for mark, n in zip(("# ", "// ", " * ", "; "), notices)]
    isc = license_digest.KNOWN["ISC"][0]
    cut = isc.replace("the above copyright notice", "the above\ncopyright notice").replace("COPYRIGHT", "\nCOPYRIGHT")
    cases += [("ISC", "Copyright 2020 A\n\n" + cut), (None, "Copyright 2020 A\n\n" + cut.replace("copyright notice and", "")), ("MIT", "Copyright (c) <year> <holder>\r\n\r\n" + license_digest.KNOWN["MIT"][0])]
    frame = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id long, text string")
    rows = license_digest.license_scan(frame).collect()
    got = {r.doc_id: r.license_id for r in rows}
    assert not [(i, k, got[i], t[:200]) for i, (k, t) in enumerate(cases) if got[i] != k]
    frame.write.parquet(f"{tmp_path}/documents")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    assert sorted(db.execute(license_digest.oracle()).fetchall()) == sorted((r.doc_id, r.digest, r.license_id) for r in rows)


def test_a_long_text_without_blanks_is_counted_in_blocks(monkeypatch):
    vocabulary = token_count.load_vocabulary(PIECES)
    rng = random.Random(5)
    pieces = [p for p, _ in vocabulary if p.isalpha() and token_count.SPACE not in p]
    text = "".join(rng.choice(pieces) if rng.random() < 0.9 else rng.choice("\u4e2d\U0001f600\u0416x") for _ in range(3000))
    whole = token_count.Counter(vocabulary).count(text)
    for block in (1, 7, 64, 1000):
        monkeypatch.setattr(token_count, "BLOCK", block)
        assert token_count.Counter(vocabulary).count(text) == whole
    monkeypatch.undo()
    counter = token_count.Counter(vocabulary)
    tracemalloc.start()
    assert counter.count(text * 40) > 30 * whole      # about 600,000 characters
    assert tracemalloc.get_traced_memory()[1] < 64 << 20 and not counter
    tracemalloc.stop()


def test_token_counts_equal_the_unigram_tokenizer(awkward, empty, docs):
    vocabulary = token_count.load_vocabulary(PIECES)
    plain = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    plain.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    rng = random.Random(2)
    texts = ["", " ", "a  b ", "x\ny", "日本 🎉🎉", "<s> <0x0A>", "▁a ▁▁"] + ["".join(rng.choice("ab c'dst\n .1éß🎉thing") for _ in range(40)) for _ in range(300)]
    counter = token_count.Counter(vocabulary)
    assert [counter.count(t) for t in texts] == [len(plain.encode(t).ids) for t in texts]
    got = {r.doc_id: r.n_tokens for r in token_count.token_counts(docs, PIECES).collect()}
    assert got == {r.doc_id: len(plain.encode(r.text).ids) for r in docs.collect()}
    rows = token_count.token_counts(awkward, PIECES).collect()
    assert len(rows) == len(AWKWARD) and {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {0}
    assert token_count.token_counts(empty, PIECES).count() == 0


def test_toxicity_neighbours_are_exact_and_found(spark, awkward, empty):
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "eps"]
    rows = [(i, " ".join(rng.choices(words, k=30) + (rng.choices(["scum", "vile"], k=1 + i % 3) if i % 4 == 0 else [])), int(i % 4 == 0)) for i in range(600)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, None), (None, 1), (1, 0)], "doc_id long, toxic int")
    index = toxicity.fit(docs, labels)
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    assert not held & set(index.ids) and set(index.terms) == {"scum", "vile"}
    dense = np.zeros((len(index.ids), len(index.terms)))
    for t, (at, value) in enumerate(index.posts):
        dense[at, t] = value
    for counts in ({0: 1}, {1: 3}, {0: 2, 1: 1}):
        t, w = index.vector(counts)
        scores = np.round(dense[:, t] @ w, 12)
        order = [i for i in np.lexsort((np.arange(len(scores)), -scores)) if scores[i] > 0][:toxicity.NEIGHBOURS]
        near, cosine = index.nearest(t, w)
        assert near.tolist() == order and np.allclose(cosine, scores[order])
    got = toxicity.toxicity(docs, labels, index=index).collect()
    assert {r.doc_id: r.predicted for r in got} == {i: y for i, _, y in rows} and {r.doc_id for r in got if r.held_out} == held
    assert toxicity.toxicity(awkward, labels, index=index).count() == len(AWKWARD)
    none = toxicity.toxicity(awkward, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)} and toxicity.toxicity(empty, labels).count() == 0


def test_toxicity_blocks_and_batches_skip_no_neighbour(monkeypatch):
    rng = random.Random(11)
    texts = [" ".join(rng.choices([f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(60)], k=rng.choice([1, 5, 40]))) for _ in range(300)] + ["w1 w2"] * 40
    examples = [(list(c), list(c.values())) for c in map(toxicity.terms_of, texts)]
    for dense_bytes, posts in ((24_000_000, 1_000_000), (0, 50), (8 * 384 * 3, 1)):  # frequent words, none, three
        monkeypatch.setattr(toxicity, "DENSE_BYTES", dense_bytes)
        monkeypatch.setattr(toxicity, "POSTS", posts)
        index, _ = toxicity.build(None, list(range(len(texts))), examples, [i % 2 for i in range(len(texts))], [1.0] * len(texts), block=32)
        rows = np.zeros((len(texts), len(index.terms)))
        for t, (at, value) in enumerate(index.posts):
            rows[at, t] = value
        vectors = [index.vector({index.terms[w]: c for w, c in toxicity.terms_of(t).items()}) for t in texts]
        without = [i if i % 3 else -1 for i in range(len(texts))]
        for (t, w), out, (near, cosine) in zip(vectors, without, index.nearest_of(vectors, 7, without), strict=True):
            scores = np.round(rows[:, t] @ w, 12)
            if out >= 0:
                scores[out] = 0
            order = [i for i in np.lexsort((np.arange(len(scores)), -scores)) if scores[i] > 0][:7]
            assert np.allclose(cosine, scores[order])
            assert near.tolist() == order or np.allclose(scores[near], scores[order])   # sums of another order may part ties


def test_toxicity_of_rare_words_over_whole_texts(spark):
    rng = random.Random(8)
    common, rows = [f"w{i}" for i in range(30)], []
    for i in range(900):  # 100 rare toxic words, each in few texts: none is a telling term
        toxic = i % 3 == 0
        pair = [f"vile{i // 3 % 50}", f"scum{i // 3 % 50}"] * 3 if toxic else [f"calm{i}"]
        rows.append((i, " ".join(rng.choices(common, k=20) + pair), int(toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    index = toxicity.fit(docs, labels)
    assert not index.terms and len(index.whole.ids) == len([i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5])
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels, index=index).collect()}
    texts = {i: toxicity.terms_of(t) for i, t, _ in rows}
    ids = sorted(index.whole.ids)
    df = {w: sum(w in texts[i] for i in ids) for w in {w for t in texts.values() for w in t}}

    def plain(i):
        v = {w: (1 + math.log(c)) * (math.log((1 + len(ids)) / (1 + df[w])) + 1) for w, c in texts[i].items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    vectors = {i: plain(i) for i in texts}
    for i, _, y in rows[::20]:
        cosine = {j: sum(x * vectors[j].get(w, 0) for w, x in vectors[i].items()) for j in ids}
        have = [cosine[j] for j in got[i].evidence]
        assert np.allclose(have, sorted(cosine.values(), reverse=True)[:toxicity.EVIDENCE])
    held = [(got[i].predicted, y) for i, _, y in rows if got[i].held_out]
    assert sum(p == y for p, y in held) >= 0.98 * len(held)


def plain_top_k(rows, k=5):
    most = sys.float_info.max
    whole = [(i, [math.floor(min(max(256 * x, -most), most)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(whole):
        if i % 50 == 0:
            clamp = lambda s: max(-2**63, min(2**63 - 1, s))
            found = sorted((-clamp(sum(a * b for a, b in zip(q, c))), j) for m, (j, c) in enumerate(whole) if m != n and len(c) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(400, 9)), 2)
    x[200:260] = x[100:160]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1001, None), (1002, [1.0, None] + [0.0] * 7), (1003, [float("nan")] * 9), (None, [1.0] * 9), (1050, [0.5, -0.5]), (1100, [])]
    rows += [(7, x[8].tolist()), (7, x[7].tolist()), (50, x[3].tolist()), (50, x[50].tolist())]      # ids used again, queries too
    rows += [(1004, [1e8, -3.5] + [0.25] * 7), (1005, [40000.0] * 9), (1150, [1e9] + [1e-3] * 8), (1006, [1e300] * 9), (1200, [1e308, -1e300] + [0.0] * 7)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for name in ("key", "dim", "wide", "rank", "part"):
        vectors = vectors.withColumn(name, vectors.vec_id)
    found = segments.segment_top_k(vectors)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == plain_top_k(rows)
    assert segments.segment_top_k(vectors.limit(0)).count() == 0


def test_top_k_sql_agrees_on_repeated_ids_and_large_components(spark, tmp_path):
    import duckdb

    from tokoledger.llm import queries

    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [9.0, 0.0]), (2, [0.1, 0.0]), (3, [1e8, 1.0]), (0, [-2.0, 4.0]), (50, [0.0, 1e8])]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = sorted(map(tuple, queries.op6_exact_top_k(spark, str(tmp_path)).collect()))
    assert found == plain_top_k(rows)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = db.execute(f"SELECT query_id, rank, vec_id, score FROM ({queries.TOP_K_SQL})").fetchall()
    assert found == sorted(want)


def test_bpe_equals_tiktoken(spark, awkward, empty, docs):
    coder = bpe.Bpe(RANKS, public_tokenizers.PATTERN)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    rng = random.Random(3)
    texts = ["", " ", "  a  b", "don't 'tis\n\n z", "a" * 3000, "=-" * 400, "".join(rng.choices("aeinrst", k=900)), "🎉日本 　x", "<|endoftext|>", "x \x1c y\x85"]
    texts += ["".join(rng.choice("ab c'dst\n\t .,1é") for _ in range(30)) for _ in range(200)]
    ids = coder.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [plain.encode_ordinary(t) for t in texts]
    assert list(coder.decode(ids)) == [t.encode() for t in texts]
    got = {r.doc_id: r for r in bpe.bpe_round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()}
    for r in docs.collect():
        want = plain.encode_ordinary(r.text)
        assert got[r.doc_id].n_tokens == len(want) and got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
    encoded = bpe.bpe_encode(awkward, RANKS, public_tokenizers.PATTERN)
    back = [r.text for r in bpe.bpe_decode(encoded, RANKS, public_tokenizers.PATTERN).collect()]
    assert sorted(back) == sorted(t or "" for _, t, _, _ in AWKWARD)
    assert bpe.bpe_round_trip(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_works_on_distinct_words_and_runs(monkeypatch):
    coder = bpe.Bpe(RANKS, public_tokenizers.PATTERN)
    asked = {"start": 0, "ids": 0}
    query = coder._query

    def counted(sql, name, rows):
        asked[name] += rows.num_rows
        return query(sql, name, rows)

    monkeypatch.setattr(coder, "_query", counted)
    text = " ".join(["thsrebleerhe onanorrest, zuentz\u00fcchxyq"] * 200)
    texts = [text, text + "  two  blanks ", "", text]
    ids = coder.encode(texts)
    assert [bytes(x) for x in coder.decode(ids)] == [t.encode() for t in texts]
    assert asked["start"] < 200 and asked["ids"] < 200          # one of each distinct word, not one of each occurrence


def test_bpe_forgets_and_decodes_unknown_ids():
    coder = bpe.Bpe(RANKS, public_tokenizers.PATTERN)
    coder.encode.kept = 3
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    rng = random.Random(5)
    for _ in range(5):
        texts = ["".join(rng.choice("ab c'dst\n .,1\u00e9") for _ in range(50)) for _ in range(20)]
        assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == [plain.encode_ordinary(t) for t in texts]
        assert len(coder.encode.slots) <= 6 and len(coder.encode.pool) == coder.encode.ends[-1]
    known = plain.encode_ordinary("so it goes")
    ids = [np.array(x, "<u4").tobytes() for x in ([], known, [10**9], [*known[:1], 2**32 - 1, *known[1:]], [])]
    assert list(coder.decode(ids)) == [b"", b"so it goes", b"", b"so it goes", b""]


def test_gathered_batches_hold_all_rows_in_order():
    from tokoledger.llm.pretokens import gathered

    rows = [(k, None if k % 7 == 0 else "x" * (k % 5 * 10)) for k in range(100)]
    batches = [pa.RecordBatch.from_pylist([{"doc_id": a, "text": b} for a, b in rows[at:at + 9]], pa.schema([("doc_id", pa.int64()), ("text", pa.string())])) for at in range(0, 100, 9)]
    found = list(gathered([batches[0].slice(0, 0), *batches], 1, 200))
    assert [tuple(r.values()) for b in found for r in b.to_pylist()] == rows
    assert 5 < len(found) < 30


def test_gru_gradients():
    net = langid.new_network(["a", "b", "c"], width=3)
    net = langid.Network(net.languages, *([p.astype(np.float64) for p in x] if isinstance(x, list) else x.astype(np.float64) for x in (net.e, net.u, net.v, net.c)))
    rng = np.random.default_rng(0)
    x, y = rng.integers(97, 100, (6, 4)).astype(np.uint8), rng.integers(0, 3, 4)

    def loss():
        states = np.zeros((6, 4, 6))
        for d in range(2):
            h = np.zeros((4, 3))
            for t in range(6) if d == 0 else range(5, -1, -1):
                h = langid._step(net.e[d], net.u[d], x[t], h)[-1]
                states[t, :, 3 * d:3 * d + 3] = h
        logits = states @ net.v + net.c
        return float(np.mean(np.log(np.exp(logits).sum(2)) - logits[:, np.arange(4), y]))

    for p, g in zip(net.params(), langid._gradients(net, x, y)):
        for _ in range(5):
            i = tuple(int(rng.integers(s)) for s in p.shape) if p.shape[0] != 256 else (int(rng.integers(97, 100)), int(rng.integers(p.shape[1])))
            old, step = p[i], 1e-5
            p[i] = old + step
            up = loss()
            p[i] = old - step
            down = loss()
            p[i] = old
            assert abs((up - down) / (2 * step) - g[i]) < 1e-6


def test_language_id(docs, awkward, empty):
    net = langid.fit(docs)
    got = {r.doc_id: r for r in langid.language_id(docs, net=net).collect()}
    held = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert {r.doc_id for r in held} == {i for i, r in got.items() if r.held_out}
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.9 * len(held)
    rows = langid.language_id(awkward, net=net).collect()
    assert len(rows) == len(AWKWARD) and {r.lang_pred for r in rows if r.doc_id in (1, 2, 8, 9)} == {"und"}
    assert all(0 <= r.score <= 1 for r in rows) and langid.language_id(empty).count() == 0
    parts = langid.document_probabilities(net, [b"the and of " * 200, b"the and of", b""])
    assert np.allclose(parts.sum(axis=1), [1, 1, 0], atol=1e-4)


def test_every_language_is_learned(spark):
    from pyspark.sql import functions as F

    many = spark.range(2400).select(F.col("id").alias("doc_id"), F.format_string("l%03d", F.col("id") % 300).alias("lang"), F.lit("some words").alias("text"))
    languages, texts, labels = langid.draw(many)
    assert len(languages) == 300 and set(labels) == set(range(300))
    seen = set()
    gradients = langid._gradients
    langid._gradients = lambda net, x, y: seen.update(y.tolist()) or gradients(net, x, y)
    try:
        langid.train(texts, labels, languages, steps=1)
    finally:
        langid._gradients = gradients
    assert seen == set(range(300))


def test_packing(spark, docs, awkward, empty):
    plain = Tokenizer.from_file(JSON)
    marked = ["<|endoftext|>", "a<|endoftext|>b c", " <|endoftext|><|endoftext|> x", "no mark", "<|endoftext| >", "x <|endoftext|>\n\n y"]
    special = spark.createDataFrame([(k, t) for k, t in enumerate(marked)], "doc_id long, text string")
    assert 50256 in plain.encode(marked[0], add_special_tokens=False).ids
    for table in (docs, special, awkward.where("doc_id is not null").dropDuplicates(["doc_id"])):
        pieces = packing.pack(table, JSON, public_tokenizers.PATTERN).collect()
        of_doc, of_sequence = {}, {}
        for p in pieces:
            of_doc.setdefault(p.doc_id, []).append(p)
            of_sequence.setdefault(p.sequence_id, []).append(p)
        for r in table.collect():
            ids, at = np.array(plain.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4"), 0
            for p in sorted(of_doc[r.doc_id], key=lambda p: p.start):
                assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(ids[at:at + p.length].tobytes()))
                at += p.length
            assert at == len(ids)
        for members in of_sequence.values():
            at = 0
            for p in sorted(members, key=lambda p: p.offset):
                assert p.offset == at
                at += p.length
            assert at <= 1024
        if table is docs:
            assert len(pieces) and sum(p.length for p in pieces) > 0.97 * 1024 * len(of_sequence)
    assert sum(p.length for p in packing.pack(awkward, JSON, public_tokenizers.PATTERN).where("doc_id is null").collect()) == 5 + 1
    assert packing.pack(empty, JSON, public_tokenizers.PATTERN).count() == 0


def test_differencing_keeps_every_item_and_the_capacity():
    rng = random.Random(1)
    for sizes in ([], [5], [1024], [1] * 50, [rng.randint(1, 256) for _ in range(500)], [1024, 1024, 1]):
        found = packing.windows_of(sizes, 1024)
        assert sorted(i for _, items in found for i in items) == list(range(len(sizes)))
        assert all(s == sum(sizes[i] for i in items) <= 1024 for s, items in found)


def test_pivot_index_against_brute_force(spark):
    rng = np.random.default_rng(8)
    base = pivots.unit(rng.normal(size=(300, 16)))
    noise = rng.normal(size=base.shape)
    noise = pivots.unit(noise - (noise * base).sum(1, keepdims=True) * base)
    near = 0.955 * base + math.sqrt(1 - 0.955 ** 2) * noise
    cluster = pivots.unit(base[0] + 0.03 * rng.normal(size=(200, 16)))
    x = np.concatenate([base, near, cluster, np.repeat(base[5:6], 40, axis=0)])
    odd = [(9000, None), (9001, [0.0] * 16), (9002, [float("inf")] + [0.0] * 15), (9003, [1.0, 2.0]), (None, base[5].tolist()), (9004, [2.0, 4.0]), (9005, [])]
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)] + [(*o, 0) for o in odd], "vec_id long, embedding array<double>, node int")
    got = {r.vec_id: r for r in pivots.embedding_near_dedup(table, block=64).collect()}
    u = pivots.unit(x)
    linked = (u @ u.T >= 0.95) & ~np.eye(len(u), dtype=bool)
    want, have = linked.sum(1), np.array([got[i].n_links for i in range(len(u))])
    assert (have <= want).all() and have.sum() >= 0.9 * want.sum()
    assert len(got) == len(x) + len(odd) and got[9003].n_links == got[9004].n_links == 1 and got[9004].component_id == 9003
    assert all(got[i].n_links == 0 and got[i].kept for i in (9000, 9001, 9002, 9005)) and not got[None].kept
    assert pivots.embedding_near_dedup(table.limit(0)).count() == 0


def test_pipeline_stages_compose(spark, small_sf, tmp_path):
    import corpus_pipeline

    docs = before = spark.read.parquet(f"{small_sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in before.collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, small_sf).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 3:
            assert after.dtypes == docs.dtypes
            kept = {r.doc_id for r in after.select("doc_id").collect()}
            assert 0.5 * docs.count() < len(kept) <= docs.count()
        if k == 2:
            roots = simhash.simhash_near_dedup(docs).where("doc_id = component_id")
            assert kept == {r.doc_id for r in roots.collect()}
        docs = after
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == kept <= texts.keys()


def test_language_stage_rejects_texts_of_no_language(spark, docs, small_sf):
    from collections import Counter

    import corpus_pipeline
    from pyspark.sql import functions as F

    rng = random.Random(6)
    odd = [*("".join(rng.choices("abcdefghijklmnopqrstuvwxyz    ", k=n)) for n in (60, 200, 3000)), "数据处理与语言" * 9, "Быстрая лиса прыгает " * 5, "zxqj vwkz qqxz " * 9, "12 34", None]
    for table in (docs, docs.where("lang = 'en'"), docs.where("lang in ('en', 'fr')")):
        planted = spark.createDataFrame([(900_000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
        mixed = table.unionByName(planted.withColumn("lang", F.lit(None).cast("string")), allowMissingColumns=True)
        kept = {r.doc_id for r in corpus_pipeline.language_stage(spark, mixed, small_sf).collect()}
        rows = {r.doc_id: r.text for r in mixed.collect()}
        assert not [i for i in kept if i >= 900_000]
        assert len(kept) >= 0.99 * table.count()

        # plain: pairs of letters counted in dictionaries
        languages, texts, labels = langid.draw(mixed)
        net = langid.train(texts, labels, languages)
        usual = langid.usual(net, texts, labels)

        def letter(b):
            c = chr(b).lower()
            return ord(c) - 96 if "a" <= c <= "z" else b - 101 if b >= 128 else 0

        def plain_pairs(text):
            c = [0] + [letter(b) for b in text]
            return [(x, y) for x, y in zip(c, c[1:]) if y]

        judged = {i: langid.judge(net, [t])[0][0] for i, t in rows.items()}
        own = langid.document_probabilities(net, texts).argmax(axis=1)
        models = {}
        for k, lang in enumerate(languages):
            mine = [plain_pairs(t) for t, y, p in zip(texts, labels, own) if y == k == p and plain_pairs(t)]
            count = Counter(p for m in mine[::2] for p in m)
            total = Counter()
            for (x, _), n in count.items():
                total[x] += n
            models[lang] = lambda p, count=count, total=total: -math.log2((count[p] + 0.01) / (total[p[0]] + 155 * 0.01))
        want = set()
        for i, t in rows.items():
            pairs = plain_pairs((t or "").encode())
            if judged[i] in languages and pairs:
                k = languages.index(judged[i])
                mean = sum(map(models[judged[i]], pairs)) / len(pairs)
                if mean <= usual.limit[k] + 3 * usual.spread[k] / math.sqrt(len(pairs)):
                    want.add(i)
        assert kept == want


def test_packing_encodes_new_chunks_together():
    """Ids are the tokenizer's for any text and any number of remembered chunks, and distinct
    words reach the tokenizer joined, not one by one."""
    import pyarrow as pa

    letters, pick = "abcdefghij", random.Random(5)
    pieces = ["a", "Foo", " ", "  ", "\n", ".", "'s", "<|endoftext|>", "12", "é", "漢", " ", "&&", "\r\n", "Ġ", "\x1c"]
    texts = [None, "", " ", " a", "a ", "a<|endoftext|> b  c"]
    texts += ["".join(pick.choices(pieces, k=pick.randrange(30))) for _ in range(500)]
    texts.append(" ".join(a + b + c + d for a in letters for b in letters for c in letters for d in "xyz"))
    direct = Tokenizer.from_file(JSON)
    for remembered in (100_000, 3, 0):
        encoder = packing._Encoder(JSON, public_tokenizers.PATTERN, remembered, 7)
        alone, encode_words = [], encoder.plain.encode_words
        encoder.plain.encode_words = lambda words: (alone.extend(words), encode_words(words))[1]
        for _ in range(2):          # the second time from what is remembered
            ids, ends = encoder(pa.array(texts, pa.string()))
            found = [x.tolist() for x in np.split(ids, ends[:-1])]
            assert found == [direct.encode(t or "", add_special_tokens=False).ids + [7] for t in texts]
        assert len(alone) < 2500    # 3000 distinct words
        assert len(encoder.slots) <= 2 * remembered
