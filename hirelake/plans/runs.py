"""Where a crawl stands, kept from run to run.

A run's listing pages and the state that the runs before left give the state after it: the last page
read, the links fetched so far, and whether the listing has ended. The state of each source is written
as a restated part (sources/restated.py), so a run that breaks off leaves the state as it was, and a
later run replaces only the sources that it touched.

Defined cases: pages up to the saved one were counted by an earlier run and do not count again; a page
captured twice in a run counts once, with the greater number of links; a page that cannot be read has no
links and ends nothing; nothing more is read of a source that has ended; a source that is new starts at
its first page; without pages the state stays as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.operators import paging
from hirelake.plans.rules import UNTIL_EMPTY
from hirelake.session import written
from hirelake.sources import restated
from hirelake.sources.requests import LISTINGS

STATE = "source string, page_no long, jobs_fetched long, ended boolean"


def after(pages: DataFrame, state: DataFrame, board: str, page_limit: int | None = None, link_total: int | None = None) -> DataFrame:
    """The state once `pages` (source, page_no, n_links) are read, under the stop rules of
    crawl.read_pages, which go on where the earlier runs stopped."""
    saved = state.select(
        "source", F.col("page_no").alias("_page"), F.col("jobs_fetched").alias("_fetched"), F.col("ended").alias("_ended")
    )
    once = pages.groupBy("source", "page_no").agg(F.max("n_links").alias("n_links"))
    open_ = F.coalesce(~F.col("_ended"), F.lit(True)) & (F.col("page_no") > F.coalesce("_page", F.lit(0)))
    fresh = written(once.join(saved, "source", "left").where(open_), f"{board}-new-pages")
    read = fresh if page_limit is None else paging.within_page_limit(fresh, page_limit)
    if board in UNTIL_EMPTY:
        read = paging.until_first_empty(read)
    if link_total is not None:
        read = paging.until_total(read, F.lit(link_total) - F.coalesce("_fetched", F.lit(0)))
    empty = F.bool_or(F.coalesce(F.col("n_links") == 0, F.lit(False))) if board in UNTIL_EMPTY else F.lit(False)
    touched = fresh.groupBy("source").agg(empty.alias("_empty"))
    page_no = F.coalesce("page_no", "_page", F.lit(0)).cast("long")
    fetched = (F.coalesce("_fetched", F.lit(0)) + F.coalesce("jobs_fetched", F.lit(0))).cast("long")
    ended = F.coalesce("_ended", F.lit(False)) | F.coalesce("_empty", F.lit(False))
    if page_limit is not None:
        ended = ended | (page_no >= page_limit)
    if link_total is not None:
        ended = ended | (fetched >= link_total)
    known = saved.join(touched, "source", "full_outer").join(paging.crawl_state(read), "source", "left")
    return known.select("source", page_no.alias("page_no"), fetched.alias("jobs_fetched"), ended.alias("ended"))


def following(state: DataFrame, board: str) -> DataFrame:
    """The listing request that each source which has not ended goes on with: source, page_no, url."""
    template, first, step = LISTINGS[board]
    number = F.lit(first) + F.col("page_no") * F.lit(step)
    url = F.replace(F.lit(template), F.lit("{}"), number.cast("string"))
    return state.where(~F.col("ended")).select("source", (F.col("page_no") + 1).alias("page_no"), url.alias("url"))


class Runs:
    """The saved state of one board's crawl under `path`; runs are numbered from 1."""

    def __init__(self, spark: SparkSession, path: str, board: str):
        self.spark, self.path, self.board = spark, path, board

    def state(self, run: int) -> DataFrame:
        """What the runs before `run` left; nothing before the first."""
        if run <= 1:
            return self.spark.createDataFrame([], STATE)
        return restated.read(self.spark, self.path, STATE)

    def finish(self, pages: DataFrame, run: int, page_limit: int | None = None, link_total: int | None = None) -> DataFrame:
        """Saves the state after the run's pages and returns it."""
        made = written(after(pages, self.state(run), self.board, page_limit, link_total), f"{self.board}-state")
        restated.restate(made, self.path, f"run-{run}", run, "source")
        return made
