"""Field extraction from pages, text lists, detail rows and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelake.catalog.registry import pages as captured_pages
from hirelake.catalog.registry import query, shape, shape_sql, table
from hirelake.catalog.sql import quoted
from hirelake.functions import html as H
from hirelake.functions import lists, urls
from hirelake.functions import text as tx
from hirelake.operators import detail_rows
from hirelake.plans import schema
from hirelake.sources import json_api

# The entities the given pages use.
_UNESCAPED = {"&middot;": "\xb7", "&copy;": "\xa9", "&quot;": '"', "&lt;": "<", "&gt;": ">", "&amp;": "&"}


def _plain(x: str) -> str:
    for entity, char in _UNESCAPED.items():
        x = f"replace({x}, {quoted(entity)}, {quoted(char)})"
    return x


_SHOWN = "regexp_replace(html, '(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'g')"


@query(f"select page_id, {_plain('''regexp_extract(html, '<title>([^<]*)</title>', 1)''')} as title from pages")
def page_title(spark, sf_dir):
    return captured_pages(spark, sf_dir).select("page_id", H.element_text(F.col("html"), "title").alias("title"))


_HEADS = f"""select page_id, {_plain("regexp_extract(html, '<title>([^<]*)</title>', 1)")} as title,
    {_plain("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")} as heading,
    {_plain(f'''regexp_extract({_SHOWN}, '<div class="ad">([^<]*)</div>', 1)''')} as ad from pages"""


@query(_HEADS)
def page_heading(spark, sf_dir):
    """Three selectors in one pass over the page."""
    rules = ["title::text", "article > h1::text", "div.ad::text"]
    named = dict(zip(("title", "heading", "ad"), rules))
    read = captured_pages(spark, sf_dir).select("page_id", H.html_fields(F.col("html"), named).alias("f"))
    return read.select("page_id", *[F.get(F.col("f")[name], F.lit(0)).alias(name) for name in named])


@query(
    f"""select page_id, len(p) as n_paragraphs, array_to_string(list_transform(p, lambda x: {_plain('x')}), '|') as paragraphs
    from (select page_id, regexp_extract_all({_SHOWN}, '<p>([^<]+)', 1) as p from pages) t"""
)
def page_paragraphs(spark, sf_dir):
    rule = "article p::text"
    texts = H.html_values(F.col("html"), rule)
    return captured_pages(spark, sf_dir).select("page_id", texts.alias("p")).select(
        "page_id", F.size("p").cast("long").alias("n_paragraphs"), F.array_join("p", "|").alias("paragraphs")
    )


@query(f"select page_id, {_plain(f'''regexp_replace({_SHOWN}, '<[^>]*>', '', 'g')''')} as text from pages")
def page_text(spark, sf_dir):
    return captured_pages(spark, sf_dir).select("page_id", H.html_text(F.col("html")).alias("text"))


LISTS = shape_sql("text_lists")


@query(f"select id, p[3] as third, p[4] as fourth, p[5] as fifth, p[6] as sixth from (select id, string_split(parts, '~') as p from {LISTS} t) u")
def fixed_positions(spark, sf_dir):
    p = F.split("parts", "~")
    names = {"third": 2, "fourth": 3, "fifth": 4, "sixth": 5}
    return shape(spark, sf_dir, "text_lists").select("id", *[lists.at(p, i).alias(n) for n, i in names.items()])


@query(
    f"""select id, p[len(p)] as last, p[len(p) - 1] as second_last, p[len(p) - 2] as third_last,
    case when len(p) >= 5 then p[len(p) - 4] end as fifth_last from (select id, string_split(parts, '~') as p from {LISTS} t) u"""
)
def end_positions(spark, sf_dir):
    p = F.split("parts", "~")
    names = {"last": -1, "second_last": -2, "third_last": -3, "fifth_last": -5}
    return shape(spark, sf_dir, "text_lists").select("id", *[lists.at(p, i).alias(n) for n, i in names.items()])


@query(
    f"""select id, p[1] as location, case when len(p) <> 3 then p[2] end as salary,
    case when len(p) = 3 then p[3] else p[4] end as employment_type from (select id, string_split(layout, '~') as p from {LISTS} t) u"""
)
def arity_layout(spark, sf_dir):
    return (
        shape(spark, sf_dir, "text_lists").select("id", lists.layout(F.split("layout", "~")).alias("l"))
        .select("id", "l.location", "l.salary", "l.employment_type")
    )


_ROUTES = {"location": "Location", "skills": "Skills", "function": "Function", "industry": "Industry"}
_LAST = ", ".join(
    f"max_by(value, seq) filter (where contains(key, '{word}')) as {name}" for name, word in _ROUTES.items()
)


@query(f"select id, {_LAST} from {shape_sql('detail_rows')} t group by id")
def detail_routing(spark, sf_dir):
    return detail_rows.routed(shape(spark, sf_dir, "detail_rows"), _ROUTES)


@query(
    """select c_custkey as id, case when c_mktsegment = 'MACHINERY' then 'Remote' else 'Site ' || c_nationkey end as location,
    c_mktsegment as industry, coalesce(case when c_acctbal > 0 then c_name end, 'IT') as function from customer"""
)
def detail_routing_lists(spark, sf_dir):
    """The same routing where a page's detail rows are a list."""
    rows = F.expr(
        """filter(array(named_struct('key', 'Job Location', 'value', concat('Site ', c_nationkey)),
        named_struct('key', 'Industry', 'value', c_mktsegment),
        if(c_acctbal > 0, named_struct('key', 'Function', 'value', c_name), null),
        if(c_mktsegment = 'MACHINERY', named_struct('key', 'Work Location', 'value', 'Remote'), null)), x -> x is not null)"""
    )
    return table(spark, sf_dir, "customer").select("c_custkey", rows.alias("rows")).select(
        F.col("c_custkey").alias("id"),
        lists.routed(F.col("rows"), "Location").alias("location"),
        lists.routed(F.col("rows"), "Industry").alias("industry"),
        F.coalesce(lists.routed(F.col("rows"), "Function"), F.lit("IT")).alias("function"),
    )


_CHAIN = ["[0-9]{5,}", "[A-Z]{3,}", "@[^ ]+", "https?:[^ ]+"]


@query(
    "select doc_id, coalesce("
    + ", ".join(f"case when len(l{i}) > 0 then array_to_string(l{i}, '') end" for i in range(len(_CHAIN)))
    + ", '-') as description from (select doc_id, "
    + ", ".join(f"regexp_extract_all(text, {quoted(p)}) as l{i}" for i, p in enumerate(_CHAIN))
    + " from documents) t"
)
def fallback_chain(spark, sf_dir):
    found = [F.regexp_extract_all("text", F.lit(p), F.lit(0)) for p in _CHAIN]
    return table(spark, sf_dir, "documents").select("doc_id", lists.first_filled(*found).alias("description"))


@query(
    """select doc_id, list_filter(string_split(text, chr(10)), lambda x: length(x) >= 200)[1] as description from documents"""
)
def first_long_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", lists.first_of_length(F.split("text", "\n"), 200).alias("description")
    )


@query(
    """select d.doc_id, coalesce(w.words, '') as words from documents d left join (
    select doc_id, string_agg(word, ' ' order by pos) as words from (
      select doc_id, word, pos, row_number() over (partition by doc_id order by pos) as rn,
        count(*) over (partition by doc_id) as n from (
        select doc_id, word, min(pos) as pos from (
          select doc_id, unnest(string_split(text, ' ')) as word, generate_subscripts(string_split(text, ' '), 1) as pos
          from documents) a group by doc_id, word) b) c
    where rn <= n - 2 and word <> '' group by doc_id) w on d.doc_id = w.doc_id"""
)
def ordered_distinct(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(lists.distinct_core(F.split("text", " ")), " ").alias("words")
    )


@query(
    f"""select job_url, case when contains(label, ' ') then regexp_extract(label, '^(.*) [^ ]*$', 1) else label end as title,
    case when contains(label, ' ') then split_part(label, ' ', -1) end as job_id from {shape_sql('cards')} t"""
)
def title_id_split(spark, sf_dir):
    label = F.col("label")
    return shape(spark, sf_dir, "cards").select(
        "job_url", tx.label_title(label).alias("title"), tx.label_id(label).alias("job_id")
    )


@query(f"select id, replace(split_part(title, location, 1), '-', '') as title from {shape_sql('titles')} t")
def title_before_location(spark, sf_dir):
    return shape(spark, sf_dir, "titles").select("id", tx.title_before(F.col("title"), F.col("location")).alias("title"))


@query(
    f"""select id, array_to_string(list_transform(list_filter(string_split(skills, '~'), lambda x: trim(x, ' ' || chr(160)) <> ''),
    lambda x: split_part(x, chr(160), 1)), ',') as skills from {LISTS} t"""
)
def skills_clean(spark, sf_dir):
    return shape(spark, sf_dir, "text_lists").select(
        "id", F.array_join(lists.clean_skills(F.split("skills", "~")), ",").alias("skills")
    )


@query("select p_partkey as id, p_type as text from part")
def icon_text(spark, sf_dir):
    return shape(spark, sf_dir, "text_lists").select("id", tx.icon_text(F.col("icon_item")).alias("text"))


@query(
    """select 'PayPal' as EmployerName, 'https://jobsearch.paypal-corp.com/' as Source, c_name as Title,
    case when c_mktsegment <> 'BUILDING' then c_mktsegment end as EmploymentIndustry,
    cast(null as varchar) as Location, cast(c_custkey as varchar) as JobID from customer"""
)
def constants_and_empties(spark, sf_dir):
    """Constant columns, empty text to null, declared fields that stay absent."""
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "  ").otherwise(F.col("c_mktsegment"))
    constant = schema.CONSTANTS["paypal"]
    raw = table(spark, sf_dir, "customer").select(
        F.lit("paypal").alias("source"),
        F.lit(constant["EmployerName"]).alias("employer_name"),
        F.concat(F.col("c_name"), F.lit("\xa0")).alias("raw_title"),
        F.array(tx.non_empty(segment)).alias("employment_industry"),
        F.col("c_custkey").cast("string").alias("job_id"),
    )
    typed = schema.conform(raw.withColumn("title", tx.non_empty(F.col("raw_title"))).drop("raw_title"))
    return schema.item_view(typed, "paypal").select(
        "EmployerName", "Source", "Title", "EmploymentIndustry", "Location", "JobID"
    )


@query(
    f"""select cast(id as varchar) as slug, c_name as title, 'https://jobs.marriott.com/marriott/jobs/' || id as job_link,
    case when id % 10 <> 0 then concat_ws(' ', n_name, r_name, n_name, cast(n_nationkey as varchar), cast(id % 1000 as varchar)) end as location,
    '''' || c_mktsegment || ''', ''' || r_name || '''' as job_function,
    'Work at' || chr(160) || n_name || 'for ' || c_mktsegment || ' & more' as description,
    'Entry Level' as experience, 'FULL_TIME' as employment_type, c_mktsegment as industry, 1 as n_jobs
    from {shape_sql('job_api')} t"""
)
def json_jobs(spark, sf_dir):
    job = F.col("job")
    return json_api.jobs(shape(spark, sf_dir, "job_api").select("body")).select(
        job["slug"].alias("slug"),
        job["title"].alias("title"),
        urls.slug_url(job["slug"], "https://jobs.marriott.com/marriott/jobs/").alias("job_link"),
        json_api.location(job).alias("location"),
        json_api.category_text(job).alias("job_function"),
        H.html_text(job["description"]).alias("description"),
        job["experience_levels"].alias("experience"),
        job["employment_type"].alias("employment_type"),
        job["industry"].alias("industry"),
        F.col("n_links").cast("int").alias("n_jobs"),
    )


@query(
    """select event_id as id, unnest([0, 1]) as pos,
    'https://mckesson.wd3.myworkdayjobs.com/job/' || unnest([event_id, event_id + 1]) as url from events"""
)
def json_nested_links(spark, sf_dir):
    rows = json_api.nested_links(shape(spark, sf_dir, "paging_api"), base="https://mckesson.wd3.myworkdayjobs.com")
    return rows.select("id", "pos", "url")


@query(
    f"""select id, case when id % 7 <> 0 then 1 end as n_jobs, case when id % 7 = 0 then 'body' end as missing
    from {shape_sql('job_api')} t"""
)
def json_jobs_and_rejects(spark, sf_dir):
    """Jobs of the responses that can be read, and a reject for each of the others."""
    body = F.when(F.col("id") % 7 == 0, F.substring("body", 1, 40)).otherwise(F.col("body"))
    bodies = shape(spark, sf_dir, "job_api").select("id", body.alias("body"))
    read = json_api.jobs(bodies).select("id", F.col("n_links").cast("int").alias("n_jobs"), F.lit(None).cast("string").alias("missing"))
    lost = json_api.unreadable(bodies, json_api.slugs())
    return read.unionByName(lost.select("id", F.lit(None).cast("int").alias("n_jobs"), F.array_join("missing", ",").alias("missing")))


@query(f"select id, cast(1 as bigint) as n_links from {shape_sql('job_api')} t")
def json_jobs_per_page(spark, sf_dir):
    return json_api.jobs_per_page(shape(spark, sf_dir, "job_api").select("id", "body")).select("id", "n_links")
