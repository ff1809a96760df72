"""Job APIs that answer in JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions import lists, urls
from hirelake.operators import links

# Names in the job API's payload, and the five parts of a location in
# the order they are printed.
LOCATION_PARTS = ["city", "state", "country", "country_code", "postal_code"]
JOB_TYPE = (
    "struct<slug:string,title:string,description:string,create_date:string,"
    "city:string,state:string,country:string,country_code:string,postal_code:string,"
    "apply_url:string,meta_data:struct<googlejobs:struct<derivedInfo:struct<jobCategories:array<string>>>>,"
    "experience_levels:string,employment_type:string,industry:string>"
)
JOBS_BODY = f"struct<jobs:array<struct<data:{JOB_TYPE}>>>"
NESTED_LINKS_PATH = "$.body.children[0].children[0].listItems"
NESTED_LINKS_TYPE = "array<struct<title:struct<commandLink:string>>>"


def jobs(captures: DataFrame, body: str = "body") -> DataFrame:
    """One row per element of `jobs[].data`, in a struct column `job`, with its place `pos`
    and the number of jobs of its response, `n_links`."""
    keep = [c for c in captures.columns if c != body]
    parsed = F.from_json(F.col(body), JOBS_BODY)["jobs"]
    bodies = captures.select(*keep, parsed.alias("_jobs")).select(*keep, F.size("_jobs").alias("n_links"), "_jobs")
    rows = links.exploded(bodies, "_jobs", [*keep, "n_links"], "entry")
    return rows.select(*keep, "n_links", "pos", F.col("entry.data").alias("job"))


def jobs_per_page(captures: DataFrame, body: str = "body") -> DataFrame:
    """Number of jobs of each response, for the stop rules; an empty response counts 0, an
    unreadable one null."""
    parsed = F.from_json(F.col(body), JOBS_BODY)["jobs"]
    return captures.withColumn("n_links", F.when(parsed.isNotNull(), F.size(parsed)).cast("long"))


def nested_hrefs(body: str = "body") -> Column:
    """The links of a nested payload; null where it cannot be read."""
    items = F.try_variant_get(F.try_parse_json(F.col(body)), NESTED_LINKS_PATH, NESTED_LINKS_TYPE)
    return items["title"]["commandLink"]


def slugs(body: str = "body") -> Column:
    """The postings' names in `jobs[].data`; null where the body cannot be read."""
    return F.from_json(F.col(body), JOBS_BODY)["jobs"]["data"]["slug"]


def unreadable(captures: DataFrame, found: Column, body: str = "body") -> DataFrame:
    """Responses that give no list at all, as rejects: with `jobs` and `nested_links` every response
    is in the result or here. `found` is what is looked for, such as `slugs()`."""
    keep = [c for c in captures.columns if c != body]
    return captures.where(found.isNull()).select(*keep, F.array(F.lit(body)).alias("missing"))


def nested_links(captures: DataFrame, body: str = "body", base: str | None = None) -> DataFrame:
    """One row per link of a deeply nested pagination payload."""
    keep = [c for c in captures.columns if c != body]
    hrefs = captures.select(*keep, nested_hrefs(body).alias("_hrefs"))
    rows = links.exploded(hrefs, "_hrefs", keep, "href")
    return rows if base is None else rows.withColumn("url", urls.absolute(F.col("href"), base))


def location(job: Column) -> Column:
    """The five parts in fixed order, only where all five are there."""
    parts = [job[name] for name in LOCATION_PARTS]
    complete = parts[0].isNotNull()
    for part in parts[1:]:
        complete = complete & part.isNotNull()
    return F.when(complete, F.concat_ws(" ", *parts))


def categories(job: Column) -> Column:
    return job["meta_data"]["googlejobs"]["derivedInfo"]["jobCategories"]


def category_text(job: Column) -> Column:
    return lists.bracketless(categories(job))
