"""What the optimizer makes of the jobs."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from hirelake.plans import boards, pipeline
from hirelake.sources import captures

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Captures partitioned by source and kind."""
    path = str(tmp_path_factory.mktemp("plans") / "captures")
    rows = [(b, k, i, f"https://x.com/{i}", "<h1>x</h1>") for b in ("paypal", "quest", "riteaid") for k in ("detail", "listing")
            for i in range(3)]
    df = spark.createDataFrame(rows, "source string, kind string, page_no long, url string, html string")
    df.withColumn("captured_at", F.lit("2024-01-01").cast("timestamp")).write.partitionBy("source", "kind").parquet(path)
    return captures.pages(spark, path)


@pytest.mark.parametrize("board", sorted(boards.BOARDS))
def test_a_page_is_parsed_once(stored, board):
    assert plan(pipeline.board_postings(stored, board)).count("ArrowEvalPython") == 1


def test_a_board_reads_its_own_folder_and_columns(stored):
    text = plan(pipeline.board_postings(stored, "paypal"))
    assert "(source" in text and "PartitionFilters: []" not in text
    assert "ReadSchema: struct<url:string,html:string,captured_at:timestamp>" in text


def test_unused_extraction_is_pruned(stored):
    slim = pipeline.board_postings(stored, "paypal").select("job_url", "captured_at")
    text = plan(slim)
    assert "ArrowEvalPython" not in text and "html" not in text


def test_one_source_of_the_union_reads_one_board(spark, stored):
    api = spark.createDataFrame([], "body string, captured_at timestamp")
    text = plan(pipeline.all_postings(stored, api).where("source = 'quest'"))
    assert text.count("ArrowEvalPython") == 1 and text.count("FileScan") == 1


def test_exploding_links_extracts_once(stored):
    listings = stored.where("source = 'quest' and kind = 'listing'")
    assert plan(boards.listing_links(listings, "quest")).count("ArrowEvalPython") == 1


@pytest.mark.parametrize("name", ["crawl_frontier", "domain_filter", "stop_total", "frontier_priority", "card_detail_join",
                                  "resume_from_state", "links_per_host", "postings_union", "retry_candidates"])
def test_no_pair_joins_and_no_single_task(spark, name):
    text = plan(entry_points.queries()[name](spark, SF))
    for word in ("NestedLoop", "Cartesian", "SinglePartition"):
        assert word not in text
