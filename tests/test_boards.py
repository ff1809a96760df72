"""Detail pages with parts missing, and the item views."""

import datetime as dt

import pytest

from hirelake.plans import boards, schema

NOW = dt.datetime(2024, 3, 31, 12, 0, 0)


def page(spark, html):
    return spark.createDataFrame([("https://x.com/1", html, NOW)], "url string, html string, captured_at timestamp")


@pytest.mark.parametrize("board", sorted(boards.BOARDS))
@pytest.mark.parametrize("html", ["", "<html><body><p>gone</p></body></html>", None])
def test_page_without_fields_gives_a_row_of_nulls(spark, board, html):
    got = schema.conform(boards.BOARDS[board](page(spark, html))).collect()
    assert len(got) == 1 and got[0].title is None and got[0].source == board


@pytest.mark.parametrize("board", sorted(schema.ITEM_FIELDS))
def test_item_view_has_the_declared_fields(spark, board):
    empty = spark.createDataFrame([], schema.POSTING)
    assert schema.item_view(empty, board).columns == schema.ITEM_FIELDS[board]


def monster(spark, body):
    return schema.conform(boards.monster_sg(page(spark, body))).first()


def test_monster_page_values_yield_to_detail_rows(spark):
    detail = '<div class="job-detail-list"><p class="dt-heading"><b>{}</b></p><p class="dt-content"><a>{}</a></p></div>'
    body = '<span class="loc">Page place</span>' + detail.format("Job Location", "First") + detail.format("Work Location", "Last")
    assert monster(spark, '<span class="loc">Page place</span>').location == "Page place"
    assert monster(spark, "<p>x</p>").location == "Singapore"
    row = monster(spark, body)
    assert row.location == "Last" and row.job_function == ["IT"]
    assert monster(spark, body + detail.format("Function", "Sales")).job_function == ["Sales"]
    assert monster(spark, "<p>x</p>").job_function is None
    late = monster(spark, detail.format("Posted On", "Posted: 3 days ago"))
    assert late.posted_raw == "Posted: 3 days ago" and late.posted_at == NOW - dt.timedelta(days=3)


def test_monster_description_levels(spark):
    wrap = '<div class="job-description-content">{}</div>'
    parts = ['<p class="jd-text">1</p>', "<ul><li>2</li></ul>", "<span>4</span>", "<div>5</div>"]
    for i, want in enumerate(["1", "2", "4", "5"]):
        assert monster(spark, wrap.format("".join(parts[i:]))).description == want
    assert monster(spark, "").description == "-"


def test_monster_job_id_primary_then_fallback(spark):
    badge = '<div><i class="pLR-10">Posted: today</i><i>x</i><i class="pLR-10">Ref: 3</i>{}</div>'
    assert monster(spark, badge.format("")).job_id == "3"
    assert monster(spark, badge.format('<i class="pLR-10">Id: 4</i>')).job_id == "4"


def test_monster_salary_only_for_permanent(spark):
    body = '<span class="package">1,000-2,000</span><span class="color-grey-light">{}</span>'
    kept, dropped = monster(spark, body.format("Permanent")), monster(spark, body.format("Temp"))
    assert tuple(kept.salary) == (1000, 2000) and kept.salary_raw == "1,000-2,000"
    assert dropped.salary is None and dropped.salary_raw == "Not specified"


def test_mckesson_short_list(spark):
    row = schema.conform(boards.mckesson(page(spark, '<div id="wd-PageContent-vbox"><div><li>T<li>L<li>x<li>y</div></div>'))).first()
    assert (row.title, row.location, row.job_id, row.employment_type) == ("T", "L", "L", "T")


def test_paypal_unescapes_twice(spark):
    html = '<div id="jdp-job-description-section"><div><b>a</b><b>b</b><p>&lt;i&gt;R &amp;amp; D&lt;/i&gt;</p><b>x</b><b>y</b><b>z</b></div></div>'
    assert boards.paypal(page(spark, html)).first().description == "R & D"


def test_pipeline_joins_all_boards(spark):
    from pyspark.sql import functions as F

    from hirelake.plans import pipeline

    pages = [("paypal", "detail", 1, "u1", '<h1 id="jdp-title-job-title">T</h1>', NOW),
             ("quest", "detail", 1, "u2", "<p>nothing</p>", NOW),
             ("paypal", "listing", 1, "u3", "<p>list</p>", NOW)]
    df = spark.createDataFrame(pages, "source string, kind string, page_no long, url string, html string, captured_at timestamp")
    api = spark.createDataFrame([('{"jobs":[{"data":{"slug":"7","title":"M","create_date":"2021-01-11T08:00:00+0000"}}]}', NOW)],
                                "body string, captured_at timestamp")
    got = pipeline.judged_postings(pipeline.all_postings(df, api))
    rows = {r.source: r for r in got.collect()}
    assert {s: r.accepted for s, r in rows.items()} == {"paypal": True, "quest": False, "marriott": True}
    assert rows["quest"].missing == ["title"] and rows["marriott"].posted_at == dt.datetime(2021, 1, 11, 8)
    assert got.where(F.col("source") == "paypal").count() == 1
