"""The corpus pipeline: language ID, toxicity, SimHash near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
and read again before the next stage. All but the last return the columns of
``documents``. A row without a doc_id stays through the filters (no decision
can name it) and is packed.
"""

from __future__ import annotations

import uuid

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tokoledger.llm import langid, packing, simhash
from tokoledger.llm import toxicity as toxic
from tokoledger.llm.common import in_arrow, table
from tokoledger.llm.pretokens import runs
from tokoledger.session import checkpoint_dir

TOGETHER = 2_000_000          # bytes of text that a worker holds as Python strings


def _filtered(docs: DataFrame, keep) -> DataFrame:
    """``docs`` without the rows that ``keep`` (texts -> booleans) rejects; all columns
    stay, and the decision falls where the row is, without a join."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in (part for whole in batches for part in runs(whole, at, TOGETHER)):
            yield batch.filter(pa.array(keep(batch.column(at).to_pylist()), pa.bool_()))

    return in_arrow(docs, run, docs.schema)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose letters are not usual in the language that the
    network gives them, go. If there is nothing to learn from, only the former do."""
    languages, texts, labels = langid.draw(docs)
    net = langid.train(texts, labels, languages) if any(texts) else None
    usual = langid.usual(net, texts, labels) if net else None
    number = {lang: k for k, lang in enumerate(languages)}

    def keep(texts):
        if net is None:
            return [langid.has_letter(t) for t in texts]
        found = langid.judge(net, texts)
        return [lang in number and langid.has_letter(t) and usual.fits(number[lang], t.encode()) for t, (lang, _) in zip(texts, found, strict=True)]

    return _filtered(docs, keep)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of at least 0.5 go."""
    scorer = toxic.scorer_of(spark, toxic.fit(docs, table(spark, sf_dir, "labels")))
    return _filtered(docs, lambda texts: [score < 0.5 for score, _, _ in scorer()(texts)])


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays, that with the smallest id (null last)."""
    return simhash.keep_one_per_group(docs, shingle=3, max_bits=2)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents in sequences of at most 1024 tokens."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(docs, tokenizer, public_tokenizers.PATTERN, capacity=1024, end_id=0, remembered=100_000, together=TOGETHER)


STAGES = [
    ("language ID", language_stage),
    ("toxicity", toxicity_stage),
    ("SimHash near-dedup", simhash_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # a trained network, nearest neighbours and XXH64 are not SQL; tests/llm compares with plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored in the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    root = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
    return docs
