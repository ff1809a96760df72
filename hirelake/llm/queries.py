"""Registered queries of the operators, each over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from hirelake.llm import (
    bpe, centroids, chat, checks, columns, decontam, langid, lines, lm, periodic, pii, quality, secrets, simhash, substring,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = dict(checks.ORACLES)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _span_list(spans, kinds):
    """kind:start:end, comma-joined."""
    names = F.array(*(F.lit(k) for k in kinds))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _chat_digests(path: str, template: chat.Template):
    kind = pa.struct([
        ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ])

    def digests(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        own = chat.Formatter(path, template)
        for formatted, starts, ends, loss in batches:
            out = []
            for i, text in enumerate(formatted.to_pylist()):
                turns = own.parse(text)
                arrays = (np.array(x[i].values.to_numpy(zero_copy_only=False)) for x in (starts, ends, loss))
                learnt = "".join(own.masked(text, *arrays))
                out.append({
                    "n_turns": len(turns),
                    "turns_sha256": hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                    "loss_chars": len(learnt),
                    "loss_sha256": hashlib.sha256(learnt.encode()).hexdigest(),
                    "formatted_chars": len(text),
                })
            yield pa.array(out, kind)

    return digests


@query
def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, and read back from what was made."""
    path, template = bpe.tokenizer_file("byte_bpe_50k.json"), chat.Template()
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(tricky).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    digests = F.arrow_udf(
        _chat_digests(path, template),
        "struct<n_turns:long,turns_sha256:string,loss_chars:long,loss_sha256:string,formatted_chars:long>",
    )
    made = chat.format_conversations(turns, path, template)
    return made.select("conv_id", digests("formatted", "starts", "ends", "loss").alias("d")).select("conv_id", "d.*")


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.cluster(docs, carry=["doc_id"]).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, and the terms that give it away."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"] < 4)
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    return pii.find(docs, carry=["doc_id"]).select(
        "doc_id",
        *(count(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS[:4])),
        F.sha2(_span_list(base, pii.KINDS), 256).alias("base_sha256"),
        _span_list(spans, pii.KINDS).alias("spans"),
    )


@query
def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows that start in an earlier one."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.dedupe(docs, carry=["doc_id"]).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def _id_digests() -> bpe.Derived:
    def digests(codec: bpe.Codec, ids: bytes) -> dict:
        numbers = np.frombuffer(ids, dtype=codec.kind).tolist()
        return {
            "n_tokens": len(numbers),
            "ids_sha256": hashlib.sha256(" ".join(map(codec.names.__getitem__, numbers)).encode()).hexdigest(),
            "decoded_sha256": hashlib.sha256(codec.decode(ids).encode()).hexdigest(),
        }

    kind = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    return bpe.Derived("d", "struct<n_tokens:long,ids_sha256:string,decoded_sha256:string>", kind, digests)


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    path = bpe.tokenizer_file("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, path, carry=["doc_id"], each=_id_digests()).select("doc_id", "d.*")


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality statistics and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality.score(docs, carry=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document under the counts of all the others."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm.score(docs, carry=["doc_id"]).select("doc_id", "n_words", "n_backoff", F.round("log_score", 6).alias("log_score"))


@query
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.col("spans")
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    return secrets.find(docs, carry=["doc_id"]).select(
        "doc_id",
        *(count(k).alias(f"n_{name}") for k, name in enumerate(secrets.KINDS[:3])),
        F.sha2(_span_list(F.filter(spans, lambda s: s["kind"] < 3), secrets.KINDS), 256).alias("base_sha256"),
        _span_list(spans, secrets.KINDS).alias("spans"),
    )


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return decontam.check(docs, items, carry=["doc_id"]).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


@query
def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that stand earlier, within one edit."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedupe(docs, carry=["doc_id"]).select(
        "doc_id", "n_removed", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256")
    )


@query
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its nearest centroid after three rounds."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    assigned, final = centroids.cluster(vectors, carry=["vec_id"])
    digests = {c: hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for c, row in enumerate(final.tolist())}
    return assigned.withColumn("centroid_sha256", centroids.per_cluster(digests, "string"))


@query
def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; learned from the labelled ones that are not held out."""
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out.alias("held_out"))
    net = langid.trained(docs.where("lang is not null and not held_out"), "doc_id")
    return langid.identify(docs.select("doc_id", "text", "held_out"), net, carry=["doc_id", "held_out"])


def looped(docs: DataFrame) -> DataFrame:
    """The texts, in a tenth of the documents with a tail of words that comes round again, as the
    contract of op13 says."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, columns.words(F.col("text"))).alias("w"))
    n, g = F.greatest(F.size("w"), F.lit(1)), F.col("g")
    a = F.pmod(g, n)
    rows = rows.select("doc_id", "text", "w", a.alias("a"), (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).alias("p"))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + F.pmod(i - F.col("a"), F.col("p"))).cast("int")
    around = F.array_join(F.transform("w", lambda _, i: F.get("w", place(i))), " ")
    return rows.select("doc_id", F.when(F.size("w") > 0, around).otherwise(F.col("text")).alias("text"))


@query
def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run of words that come round again, and what is left without their repeats."""
    docs = looped(table(spark, sf_dir, "documents").select("doc_id", "text"))
    runs = F.col("runs")
    # length / period compared exactly; of equal ones the first stays, and runs come by start and period.
    more = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    best = F.aggregate(runs, F.lit(None).cast(periodic.RUN), lambda b, r: F.when(more(b, r), r).otherwise(b))
    lines_ = F.transform(runs, lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    found = periodic.find(docs, carry=["doc_id"]).select("doc_id", "runs", "kept_text", best.alias("best"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines_, ""), 256).alias("runs_sha256"), F.sha2("kept_text", 256).alias("collapsed_sha256"),
    )


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline over the documents."""
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
