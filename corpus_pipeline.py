"""The corpus pipeline: each stage calls one operator of ``wiretable.llm``.

A stage takes the documents that its predecessor kept and returns documents with
the same columns; the last returns piece ids.  ``ORACLE_SQL`` is None: the learned
toxicity model, XXH64 and the tokenizer have no SQL form, so the stages are tested
against plain versions in ``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wiretable.llm.decontaminate import decontaminate
from wiretable.llm.frames import stored, table
from wiretable.llm.secrets import scan
from wiretable.llm.sentencepiece_codec import encode
from wiretable.llm.simhash import keep_one
from wiretable.llm.toxicity import score_toxicity
from wiretable.session import Workspace

TOXIC = 0.5
MASK = "[secret]"

ORACLE_SQL = None


def _with_text(found: DataFrame, columns: list[str]) -> DataFrame:
    """The carried rows with the cleaned text (null stays null) and its length."""
    text = F.when(F.col("row.text").isNotNull(), F.col("clean_text"))
    own = {"text": text.alias("text"), "n_chars": F.length(text).cast("bigint").alias("n_chars")}
    return found.select(*[own.get(c, F.col(f"row.`{c}`")) for c in columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches 0.5 go."""
    found = score_toxicity(docs, table(spark, sf_dir, "labels"), carry=True)
    return found.where(F.col("score") < TOXIC).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the least doc_id."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"), with_text=True, carry=True)
    return _with_text(found, docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts."""
    return _with_text(scan(docs, mask=MASK, carry=True), docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as SentencePiece ids."""
    found = encode(docs, carry=True)
    return found.select("doc_id", F.col("row.lang").alias("lang"), F.col("row.source").alias("source"), "n_tokens", "ids")


STAGES = [
    ("toxicity", toxicity),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("sentencepiece", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what each keeps is written and read again, as the next reads it twice.

    A stage's intermediate tables, and the table it read, are removed once what it keeps
    is written, so at most two copies of the documents lie in the checkpoint folder.
    """
    docs, held = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        work, kept = Workspace(spark), Workspace(spark)
        with work:
            out = stage(spark, docs, sf_dir)
        with kept:
            docs = stored(out)
        work.close()
        if held:
            held.close()
        held = kept
    return STAGES[-1][1](spark, docs, sf_dir)
