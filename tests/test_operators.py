"""Link, frontier, paging, quality and sink operators against brute force and by property."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from hirelake.operators import cards, detail_rows, frontier, links, paging, quality
from hirelake.plans import schema
from hirelake.sources import captures, json_api, requests, sinks


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def listing(spark):
    rnd = random.Random(7)
    data = [("hot", p, rnd.randint(0, 9)) for p in range(1, 200)] + [("b", p, 5 if p < 4 else 0) for p in range(1, 7)]
    rnd.shuffle(data)
    return data, spark.createDataFrame(data, "source string, page_no long, n_links long").cache()


@pytest.mark.parametrize("width", [1, 7, 10_000])
def test_until_total_is_the_loop(spark, listing, width):
    data, df = listing
    want, fetched = [], collections.Counter()
    for source, page, n in sorted(data):
        if page == 1 or fetched[source] < 300:
            want.append((source, page))
        fetched[source] += n
    assert rows(paging.until_total(df, 300, width), "source", "page_no") == want


def test_until_first_empty(spark, listing):
    data, df = listing
    stop = {}
    for source, page, n in sorted(data):
        if n == 0:
            stop.setdefault(source, page)
    want = sorted((s, p) for s, p, _ in data if p < stop.get(s, 10**9))
    assert rows(paging.until_first_empty(df), "source", "page_no") == want


def test_stop_rules_give_prefixes(spark, listing):
    _, df = listing
    for kept in (paging.until_total(df, 50), paging.until_first_empty(df), paging.within_page_limit(df, 3)):
        per_source = kept.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.max("page_no").alias("m")).collect()
        assert all(r.n == r.m for r in per_source)


def test_resume(spark, listing):
    _, df = listing
    state = spark.createDataFrame([("b", 4, 15)], "source string, page_no long, jobs_fetched long")
    got = paging.resume(df, state)
    assert rows(got.where("source = 'b'"), "page_no", "fetched_before") == [(4, 15), (5, 15), (6, 15)]
    assert got.where("source = 'hot' and fetched_before = 0").count() == 199
    assert rows(paging.crawl_state(df).where("source = 'b'"), "page_no", "jobs_fetched") == [(6, 15)]


@pytest.mark.parametrize("block,width", [(1, 1), (3, 2), (1000, 64)])
@pytest.mark.parametrize("limit", [20, None])
def test_rank_is_the_sort(spark, block, width, limit):
    rnd = random.Random(3)
    data = [(s, p, i, n) for s, pages in (("hot", 40), ("b", 5)) for p in range(1, pages)
            for n in [rnd.randint(1, 6)] for i in range(n)]
    df = spark.createDataFrame(data, "source string, page_no long, pos long, n_links long")
    got = frontier.ranked(frontier.detail_requests(df, limit), block, width)
    want, seen = [], collections.Counter()
    priority = (lambda p, i, n: limit + n - i) if limit else (lambda p, i, n: p - i)
    for s, down, p, i in sorted((s, -priority(p, i, n), p, i) for s, p, i, n in data):
        seen[s] += 1
        want.append((s, p, i, -down, seen[s]))
    assert rows(got, "source", "page_no", "pos", "priority", "fetch_rank") == sorted(want)


def test_unseen_is_idempotent(spark):
    data = [("a", 2, 0, "http://x.com/1#f"), ("a", 1, 3, "http://X.com/1"), ("a", 1, 4, "http://x.com/2"), ("b", 1, 0, "http://x.com/1")]
    found = spark.createDataFrame(data, "source string, page_no long, pos long, url string")
    none = spark.createDataFrame([], "source string, url_norm string")
    first = frontier.unseen(found, none)
    assert rows(first, "source", "url_norm", "page_no") == [
        ("a", "http://x.com/1", 1), ("a", "http://x.com/2", 1), ("b", "http://x.com/1", 1)]
    assert frontier.unseen(found, first).count() == 0


def test_allowed_domains(spark):
    data = [("a", "http://x.com/"), ("a", "http://w.x.com/"), ("a", "http://notx.com/"), ("b", "http://x.com/"), ("a", "no url")]
    found = spark.createDataFrame(data, "source string, url string")
    domains = spark.createDataFrame([("a", "X.com")], "source string, domain string")
    assert rows(frontier.allowed(found, domains), "source", "url") == [("a", "http://w.x.com/"), ("a", "http://x.com/")]


def test_listing_priority_follows_details(spark):
    df = spark.createDataFrame([("a", 3, "u")], "source string, page_no long, url string")
    assert frontier.listing_request_rows(df, 20).first().priority == 18
    assert frontier.listing_request_rows(df, None).first().priority == -3


def test_requests(spark):
    df = spark.createDataFrame([("a", 0, 49), ("b", 5, 4)], "source string, start long, stop long")
    got = requests.listing_requests(df, "u?o={}", 25)
    assert rows(got, "source", "page_no", "number", "url") == [("a", 1, 0, "u?o=0"), ("a", 2, 25, "u?o=25")]
    big = spark.createDataFrame([("a", 1, 25_000)], "source string, start long, stop long")
    many = requests.listing_requests(big, "{}")
    assert (many.count(), many.select("url").distinct().count()) == (25_000, 25_000)
    boards = requests.board_requests(spark.createDataFrame([("cisco", 2), ("x", 3)], "source string, last_page long"))
    assert [r.number for r in boards.orderBy("page_no").collect()] == [0, 25]


def test_card_slices_and_sponsors(spark):
    html = ('<div class="c"><a href="/1">x</a></div><div class="c"><i class="ad">ad</i><a href="/2">x</a></div><div class="c"></div>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    found = links.cards(pages, "div.c", {"href": "a::attr(href)", "sponsored": "i.ad::text"})
    assert rows(found, "pos", "href", "sponsored") == [(0, "/1", None), (1, "/2", "ad"), (2, None, None)]
    assert rows(links.unsponsored(found).where("href is not null"), "href") == [("/1",)]
    assert rows(links.region_links(pages, "div.c a::attr(href)", start=1), "pos", "href") == [(0, "/2")]
    assert links.page_links(spark.createDataFrame([(1, "none")], "page_id long, html string")).count() == 0


def test_cards_good_and_rejected_are_all(spark):
    c = spark.createDataFrame([(f"u{i}", " x ", "T 1" if i % 4 else "T") for i in range(40)], "job_url string, industry string, label string")
    d = spark.createDataFrame([(f"u{i}", "L" if i % 3 else " ", "D" if i % 5 else None, "A") for i in range(30)],
                              "job_url string, location string, description string, apply_url string")
    judged = cards.joined(c, d)
    good, bad = quality.accepted(judged), quality.rejected(judged)
    assert good.count() + bad.count() == 40
    assert good.where("location is null or description is null or job_id is null").count() == 0
    assert rows(bad.where("job_url = 'u0'"), "location", F.array_join("missing", ",")) == [("", "description,job_id")]
    assert rows(bad.where("job_url >= 'u30' and job_url <= 'u39' and length(job_url) = 3"), F.array_join("missing", ",")) == [("detail",)] * 10


def test_latest_detail_wins_and_hot_url_joins_whole(spark):
    c = spark.createDataFrame([("hot", "x", f"T {i}") for i in range(500)], "job_url string, industry string, label string")
    d = spark.createDataFrame([("hot", f"L{i}", "D", "A", i) for i in range(50)],
                              "job_url string, location string, description string, apply_url string, captured_at long")
    got = cards.postings(c, cards.latest_details(d))
    assert got.count() == 500 and {r.location for r in got.collect()} == {"L49"}


def test_detail_rows_last_wins(spark):
    df = spark.createDataFrame([(1, 1, "Location", "a"), (1, 2, "Work Location", "b"), (1, 3, "Other", "c")],
                               "id long, seq int, key string, value string")
    assert rows(detail_rows.routed(df, {"location": "Location", "skills": "Skills"}), "id", "location", "skills") == [(1, "b", None)]


def test_failure_classes_and_retries(spark):
    log = [("a", 1, 1, 200, None), ("b", 1, 2, 503, "HttpError"), ("b", 2, 3, None, "DNSLookupError"), ("c", 1, 4, None, "TimeoutError"),
           ("c", 2, 5, 200, None), ("d", 1, 6, None, "TCPTimedOutError"), ("e", 1, 7, None, "Odd"), ("e", 2, 8, None, "Odd"), ("f", 1, 9, None, None)]
    df = spark.createDataFrame(log, "url string, ts long, event_id long, status int, error string")
    df = df.withColumn("failure", quality.failure_class(F.col("status"), F.col("error"))).withColumn("source", F.lit("s"))
    assert rows(df, "event_id", "failure") == list(enumerate(
        ["ok", "http", "dns", "timeout", "ok", "timeout", "unknown", "unknown", "unknown"], 1))
    assert rows(quality.failure_counts(df), "failure", "n") == [("dns", 1), ("http", 1), ("timeout", 2), ("unknown", 3)]
    assert rows(quality.retry_candidates(df, 2), "url", "attempts", "last_failure") == [("d", 1, "timeout"), ("f", 1, "unknown")]


def test_csv_rejects_undeclared_and_keeps_text(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a "q", b\nc', None, ["x"])], "JobID string, Title string, Location string, Source array<string>")
    path = str(tmp_path / "csv")
    with pytest.raises(ValueError):
        sinks.append_csv(df.withColumn("JobDescription2", F.lit("x")), path, schema.ITEM_FIELDS["cisco"])
    for _ in range(2):
        sinks.append_csv(df, path, schema.ITEM_FIELDS["cisco"])
    got = sinks.read_csv(spark, path, schema.ITEM_FIELDS["cisco"])
    assert got.columns == schema.ITEM_FIELDS["cisco"]
    assert rows(got, "JobID", "Title", "Location", "Source") == [("1", 'a "q", b\nc', "", '["x"]')] * 2


def test_conform(spark):
    df = schema.conform(spark.createDataFrame([("t",)], "title string"))
    assert df.schema.names == schema.POSTING.names and df.first().title == "t"
    with pytest.raises(ValueError):
        schema.conform(spark.createDataFrame([("t",)], "Nope string"))


def test_union_of_item_shapes(spark):
    a = spark.createDataFrame([("1", "A", "Ind", "2-3 years")], "JobID string, Title string, EmploymentIndustry string, Experience string")
    b = spark.createDataFrame([(2, "B", ["x", "y"], (1, 2))], "JobID long, JobTitle string, Skills array<string>, Experience struct<min:int,max:int>")
    got = schema.combine([schema.from_items(a, "a"), schema.from_items(b, "b")])
    first, second = got.orderBy("source").collect()
    assert (first.job_id, first.title, first.employment_industry, first.experience_raw) == ("1", "A", ["Ind"], "2-3 years")
    assert (second.job_id, second.skills, tuple(second.experience)) == ("2", ["x", "y"], (1, 2))


def test_json_bodies(spark):
    bodies = ['{"jobs":[{"data":{"slug":"1","city":"C"}},{"data":{"slug":"2"}}]}', '{"jobs":[]}', "broken", None]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "page_no int, body string")
    assert rows(json_api.jobs(df), "page_no", "pos", "job.slug") == [(0, 0, "1"), (0, 1, "2")]
    assert rows(json_api.jobs_per_page(df), "page_no", "n_links") == [(0, 2), (1, 0), (2, None), (3, None)]
    assert rows(json_api.unreadable(df, json_api.slugs()), "page_no", "missing") == [(2, ["body"]), (3, ["body"])]
    nested = ['{"body":{"children":[{"children":[{"listItems":[{"title":{"commandLink":"/j/1"}}]}]}]}}', '{"body":{}}', "broken", None]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(nested)], "start int, body string")
    assert rows(json_api.nested_links(df, base="https://m.com"), "start", "url") == [(0, "https://m.com/j/1")]


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"jobs":[{"data":{"slug":"1"}}]}\n{"jobs":[]}\n')
    got = json_api.jobs(captures.json_lines(spark, str(tmp_path)))
    assert rows(got, "job.slug") == [("1",)]


def test_spread_only_small_tables(spark):
    small = spark.range(10).repartition(1)
    large = spark.range(10).repartition(64)
    assert captures.spread(small, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert captures.spread(large, "id").rdd.getNumPartitions() == 64


def test_detail_frontier_stops_where_the_board_does(spark):
    from hirelake.plans import boards, crawl

    card = '<mat-expansion-panel class="mat-expansion-panel"><a href="/jobs/{}" aria-label="T">x</a></mat-expansion-panel>'
    page = '<div class="job-results-container"><search-job-cards><mat-accordion>{}</mat-accordion></search-job-cards></div>'
    data = [("riteaid", p, page.format("".join(card.format(i) for i in ids))) for p, ids in
            [(1, [1, 2]), (2, [2, 3]), (3, []), (4, [9])]]
    df = spark.createDataFrame(data, "source string, page_no long, html string")
    seen = spark.createDataFrame([("riteaid", "https://careers.riteaid.com/jobs/1")], "source string, url_norm string")
    got = crawl.detail_frontier(df, seen, "riteaid")
    assert rows(got, "fetch_rank", "page_no", "pos", "url") == [
        (1, 2, 1, "https://careers.riteaid.com/jobs/3"), (2, 1, 1, "https://careers.riteaid.com/jobs/2")]
    counts = boards.listing_pages(df, "riteaid")
    assert crawl.next_listing(counts, "riteaid").count() == 0
    going_on = counts.where("page_no < 3")
    assert rows(crawl.next_listing(going_on, "riteaid"), "source", "page_no", "jobs_fetched") == [("riteaid", 3, 4)]


def test_unreadable_pages_do_not_end_a_listing(spark):
    from hirelake.plans import boards, crawl

    df = spark.createDataFrame([("riteaid", 1, None), ("riteaid", 2, "<p>none</p>")], "source string, page_no long, html string")
    counts = boards.listing_pages(df, "riteaid")
    assert rows(counts, "page_no", "n_links") == [(1, None), (2, 0)]
    assert rows(crawl.read_pages(counts, "riteaid"), "page_no") == [(1,)]


def test_boards_that_page_by_json(spark):
    from hirelake.plans import crawl

    nested = '{"body":{"children":[{"children":[{"listItems":[{"title":{"commandLink":"/j/1"}},{"title":{"commandLink":"/j/2"}}]}]}]}}'
    jobs = '{"jobs":[{"data":{"slug":"5"}}]}'
    seen = spark.createDataFrame([], "source string, url_norm string")
    for board, bodies, want in [
        ("mckesson", [nested, "broken"], ["https://mckesson.wd3.myworkdayjobs.com/j/1", "https://mckesson.wd3.myworkdayjobs.com/j/2"]),
        ("marriott", [jobs, None], ["https://jobs.marriott.com/marriott/jobs/5"]),
    ]:
        df = spark.createDataFrame([(board, i + 1, b) for i, b in enumerate(bodies)], "source string, page_no long, body string")
        assert [r[1] for r in rows(crawl.detail_frontier(df, seen, board), "fetch_rank", "url")] == want


def test_next_listing_keeps_to_limits(spark):
    from hirelake.plans import crawl

    df = spark.createDataFrame([("m", p, 5) for p in range(1, 21)], "source string, page_no long, n_links long")
    assert crawl.next_listing(df, "monster_sg", page_limit=20).count() == 0
    assert rows(crawl.next_listing(df, "monster_sg"), "page_no", "jobs_fetched") == [(21, 100)]
    assert rows(crawl.next_listing(df, "paypal", link_total=1000), "page_no", "jobs_fetched") == [(21, 100)]
    assert crawl.next_listing(df, "paypal", link_total=40).count() == 0


def test_first_page_is_read_whatever_the_total(spark):
    df = spark.createDataFrame([("s", p, 5) for p in range(1, 4)], "source string, page_no long, n_links long")
    assert rows(paging.until_total(df, 0), "page_no") == [(1,)]
    assert rows(paging.until_total(df, F.lit(None).cast("long")), "page_no") == [(1,), (2,), (3,)]


def test_many_small_crawls_are_spread(spark):
    from hirelake.sources import requests

    crawls = spark.range(1000).selectExpr("concat('s', id) source", "1 start", "20 stop")
    made = requests.listing_requests(crawls, "https://x.com/{}").select(F.spark_partition_id().alias("p"))
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    try:
        sizes = [r["count"] for r in made.groupBy("p").count().collect()]
    finally:
        spark.conf.unset(merge)
    assert sum(sizes) == 20_000 and max(sizes) < 12_000


def test_rank_of_tied_requests_is_by_url(spark):
    data = [("s", 1, 0, 5, u) for u in ("b", "a", "c")]
    df = spark.createDataFrame(data, "source string, page_no long, pos long, priority long, url string")
    assert rows(frontier.ranked(df), "fetch_rank", "url") == [(1, "a"), (2, "b"), (3, "c")]


def test_retries_by_kind_of_request(spark):
    from hirelake.plans import crawl

    log = spark.createDataFrame([("u", i, i, "http") for i in range(7)], "url string, ts long, event_id long, failure string")
    assert crawl.retries(log, "listing").count() == 0
    assert rows(crawl.retries(log, "detail"), "url", "attempts") == [("u", 7)]


def test_details_and_next_listing_are_ranked_together(spark):
    from hirelake.plans import crawl

    card = '<div class="job-results-container"><search-job-cards><mat-accordion><mat-expansion-panel class="mat-expansion-panel"><a href="/jobs/{}" aria-label="T">x</a></mat-expansion-panel></mat-accordion></search-job-cards></div>'
    df = spark.createDataFrame([("riteaid", 1, card.format(1)), ("riteaid", 2, card.format(2))], "source string, page_no long, html string")
    seen = spark.createDataFrame([], "source string, url_norm string")
    got = rows(crawl.all_requests(df, seen, "riteaid"), "fetch_rank", "kind", "url")
    assert got == [(1, "detail", "https://careers.riteaid.com/jobs/2"), (2, "detail", "https://careers.riteaid.com/jobs/1"),
                   (3, "listing", "https://careers.riteaid.com/jobs?page=3")]


def test_next_page_is_the_last_page_link(spark):
    from hirelake.plans import boards

    html = '<div id="search-content"><p><a href="/p=1">1</a><a href="/p=3">next</a></p></div><a href="/other">o</a>'
    df = spark.createDataFrame([("careerjet", 2, html), ("careerjet", 9, "<p>x</p>")], "source string, page_no long, html string")
    assert rows(boards.next_page(df, "careerjet"), "page_no", "next_url") == [(2, "https://www.careerjet.co.in/p=3"), (9, None)]


NESTED = '{{"body":{{"children":[{{"children":[{{"listItems":[{{"title":{{"commandLink":"/j/{}"}}}}]}}]}}]}}}}'
RITEAID = ('<div class="job-results-container"><search-job-cards><mat-accordion><mat-expansion-panel class="mat-expansion-panel">'
           '<a href="/jobs/{}" aria-label="T">x</a></mat-expansion-panel></mat-accordion></search-job-cards></div>')
MONSTER = '<div class="card-panel job-apply-card"><div class="job-tittle"><h3><a href="//www.monster.com.sg/job/{}">x</a></h3></div></div>'


@pytest.mark.parametrize("board", ["careerjet", "cisco", "lockheed", "marriott", "mckesson", "monster_sg", "paypal", "quest", "riteaid"])
def test_every_board_gives_details_and_its_next_listing(spark, board):
    from hirelake.catalog.html_shapes import LISTING_HTML
    from hirelake.plans import crawl

    schema_of = "source string, page_no long, {} string"
    made = {"mckesson": NESTED, "marriott": '{{"jobs":[{{"data":{{"slug":"{}"}}}}]}}', "riteaid": RITEAID, "monster_sg": MONSTER}
    if board in made:
        body = "body" if board in ("mckesson", "marriott") else "html"
        df = spark.createDataFrame([(board, p, made[board].format(p)) for p in (1, 2)], schema_of.format(body))
    else:
        df = spark.range(1, 3).selectExpr("id p_partkey", "id p_size").select(
            F.lit(board).alias("source"), F.col("p_partkey").alias("page_no"), F.expr(LISTING_HTML[board]).alias("html"))
    seen = spark.createDataFrame([], "source string, url_norm string")
    got = crawl.all_requests(df, seen, board).collect()
    assert {r.page_no for r in got if r.kind == "detail"} == {1, 2}
    assert [r.page_no for r in got if r.kind == "listing"] == [3]
    details = {r.url for r in got if r.kind == "detail"}
    assert details == {r.url for r in crawl.detail_frontier(df, seen, board).collect()}


def test_log_is_folded_once_in_tasks_of_one_size(spark):
    log = spark.createDataFrame(
        [(u, i, i, "timeout") for u, n in (("a", 3), ("b", 7), ("c", 12), ("d", 20)) for i in range(n)], "url string, ts long, event_id long, failure string"
    )
    attempts = {"start": 5, "start_capped": 10, "detail": 15}
    by_kind = quality.retries_by_kind(log, attempts)
    apart = [(kind, r["url"], r["attempts"], "timeout") for kind, most in attempts.items() for r in quality.retry_candidates(log, most).collect()]
    assert sorted(map(tuple, by_kind.collect())) == sorted(apart) and len(apart) == 6
    plan = by_kind._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RebalancePartitions [url") == 1 and plan.count("Aggregate [url") == 1
