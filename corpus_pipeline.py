"""Documents to training tokens in five stages, each over all that the one before it kept.

    quality          documents that the rules reject go
    line_dedup       lines that stand earlier, within one edit, are cut out of the texts
    near_dedup       of documents whose SimHash fingerprints link (4-word shingles, 4 bits) one stays, the least id
    decontamination  documents with a window of a benchmark item go
    tokens           texts become token ids

All stages but the last return the columns of `documents`; `n_chars` follows the text. A
document of which no line is left keeps its row with an empty text; such rows are near
copies of each other (fingerprint zero), so one of them stays. Null texts are empty; repeated rows are copies;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm import bpe, decontam, lines, quality, simhash
from hirelake.session import removed, tables_made, written

TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.deduped(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.kept(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.kept(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and the packed ids."""
    path = bpe.tokenizer_file(TOKENIZER)
    width = bpe.id_bytes(path)
    coded = bpe.encode(docs, path, carry=["doc_id", "lang", "source"])
    return coded.select("doc_id", "lang", "source", (F.length("ids") / width).cast("long").alias("n_tokens"), "ids")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_before: list[str] = []


def _tidy(stage: Stage) -> Stage:
    """The stage, removing what the stage before it left in the shared folder: when a stage
    begins, the result of the one before has been written and its tables are done with, unless
    `docs` still reads them."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles()
        removed(spark, [path for path in _before if not any(path in file for file in read)])
        with tables_made() as made:
            out = stage(spark, docs, sf_dir)
        _before[:] = made
        return out

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("quality", _tidy(quality_rules)),
    ("line_dedup", _tidy(line_dedup)),
    ("near_dedup", _tidy(near_dedup)),
    ("decontamination", _tidy(decontamination)),
    ("tokens", _tidy(tokens)),
]
#: The robust fit, components and the tokenizer have no SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, earlier = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        with tables_made() as made:
            docs = written(out, name)
        removed(spark, earlier)
        earlier = made
    return docs
