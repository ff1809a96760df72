"""Rejects, failure classes, counters and retries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing(required: Sequence[str]) -> Column:
    """Names of the required fields a row lacks."""
    marks = [F.when(F.col(c).isNull(), F.lit(c)) for c in required]
    return F.array_compact(F.array(*marks))


def judged(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Every row, with `accepted` and the list of missing fields."""
    return df.withColumn("missing", missing(required)).withColumn("accepted", F.size("missing") == 0)


def accepted(judged_rows: DataFrame) -> DataFrame:
    return judged_rows.where("accepted").drop("accepted", "missing")


def rejected(judged_rows: DataFrame) -> DataFrame:
    return judged_rows.where("not accepted").drop("accepted")


def reject_reasons(judged_rows: DataFrame) -> DataFrame:
    """Rejected rows per missing field."""
    return (
        judged_rows.where("not accepted").select(F.explode("missing").alias("field"))
        .groupBy("field").agg(F.count(F.lit(1)).alias("n"))
    )


# Error names that mean a lookup failure or a timeout.
DNS_ERRORS = ["DNSLookupError"]
TIMEOUT_ERRORS = ["TimeoutError", "TCPTimedOutError"]


def failure_class(status: Column, error: Column) -> Column:
    """ok / http / dns / timeout / unknown from a response status and an error name."""
    return (
        F.when(error.isin(*DNS_ERRORS), "dns")
        .when(error.isin(*TIMEOUT_ERRORS), "timeout")
        .when(error.isNotNull() & (error != "HttpError"), "unknown")
        .when(status.between(200, 299), "ok")
        .when(status.isNotNull(), "http")
        .otherwise("unknown")
    )


def failure_counts(log: DataFrame, by: Sequence[str] = ("source",)) -> DataFrame:
    return (
        log.where(F.col("failure") != "ok").groupBy(*by, "failure").agg(F.count(F.lit(1)).alias("n"))
    )


def page_counters(links: DataFrame, by: Sequence[str] = ("source", "page_no")) -> DataFrame:
    """Links per listing page."""
    return links.groupBy(*by).agg(F.count(F.lit(1)).alias("n_links"))


def source_counters(pages: DataFrame) -> DataFrame:
    """Jobs fetched and responses handled per source, from `(source, n_links)` rows."""
    return pages.groupBy("source").agg(
        F.sum("n_links").cast("long").alias("jobs_fetched"), F.count(F.lit(1)).alias("responses")
    )


def retry_candidates(log: DataFrame, max_attempts: int) -> DataFrame:
    """URLs whose last attempt failed and that have attempts left.

    `log` holds url, ts, event_id, failure; the log of one URL folds before the shuffle."""
    return _retriable(last_attempts(log), F.col("attempts") < max_attempts)


def retries_by_kind(log: DataFrame, attempts: dict[str, int]) -> DataFrame:
    """(kind, url, attempts, last_failure): the candidates of each kind of request with its number of
    attempts. The log is folded once for all of them."""
    kinds = F.array(*(F.struct(F.lit(kind).alias("kind"), F.lit(most).alias("most")) for kind, most in attempts.items()))
    left = last_attempts(log).where(F.col("attempts") < max(attempts.values())).withColumn("_k", F.explode(kinds))
    return _retriable(left, F.col("attempts") < F.col("_k.most"), F.col("_k.kind"))


def _retriable(last: DataFrame, has_left: Column, *more: Column) -> DataFrame:
    return last.where((F.col("_last.failure") != "ok") & has_left).select(
        *more, "url", "attempts", F.col("_last.failure").alias("last_failure")
    )


def last_attempts(log: DataFrame) -> DataFrame:
    """(url, attempts, _last): attempts of each URL and the last of them.

    The maximum of structs sorts a task's rows, so the log is dealt to tasks of one size first,
    however large its files are; a URL with very many rows is split among tasks and folds there."""
    dealt = log.hint("rebalance", F.col("url"))
    return dealt.groupBy("url").agg(
        F.count(F.lit(1)).alias("attempts"), F.max(F.struct("ts", "event_id", "failure")).alias("_last")
    )
