"""Canonical postings, the boards' declared item fields, and the way between them."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.functions import dates
from hirelake.functions import lists

_TEXTS = T.ArrayType(T.StringType())
_RANGE = T.StructType().add("min", "long").add("max", "long")

POSTING = (
    T.StructType()
    .add("source", "string")
    .add("employer_name", "string")
    .add("job_id", "string")
    .add("title", "string")
    .add("location", "string")
    .add("employment_type", "string")
    .add("employment_industry", _TEXTS)
    .add("job_function", _TEXTS)
    .add("skills", _TEXTS)
    .add("experience", _RANGE)
    .add("experience_raw", "string")
    .add("salary", _RANGE)
    .add("salary_raw", "string")
    .add("currency", "string")
    .add("posted_raw", "string")
    .add("posted_at", "timestamp")
    .add("posted_date", "date")
    .add("description", "string")
    .add("job_url", "string")
    .add("apply_url", "string")
    .add("captured_at", "timestamp")
)

# The fields each board declares, in order.
ITEM_FIELDS = {
    "marriott": (
        "Title JobLink JobFunction JobID Location EmploymentType Description PAGE PostedAt EmployerName"
        " ApplyLink Source Experience EmploymentIndustry"
    ).split(),
    "paypal": (
        "Title Location EmploymentIndustry EmploymentType JobURL JobID PostedAt Source EmployerName"
        " Experience JobDescription"
    ).split(),
    "quest": (
        "Title Location EmploymentType EmploymentIndustry JobDescription JobID PostedAt JobURL Source"
    ).split(),
    "lockheed": (
        "Title Location EmploymentIndustry EmploymentType JobURL JobID PostedAt Source EmployerName"
        " Experience JobDescription ApplyLink"
    ).split(),
    "careerjet": (
        "Title Location Salary EmploymentType EmployerName JobDescription ApplyLink PostedAt JobURL Source"
    ).split(),
    "monster_sg": (
        "JobTitle Location Industry JobFunction JobRole Salary Currency EmploymentType Experience"
        " EmployerName EmploymentIndustry JobDescription JobQualifications JobApplyLink JobID PostedAt"
        " JobURL Skills Source"
    ).split(),
    "cisco": "JobID Title Location EmploymentIndustry JobDescription Source JobURL".split(),
    "riteaid": (
        "JobID Title Location EmploymentIndustry JobDescription Source EmployerName ApplyLink JobURL"
    ).split(),
    "mckesson": (
        "JobID Title PostedAt Location EmploymentType Description Source PAGE ApplyLink"
    ).split(),
}

# Constants of each board's items.
CONSTANTS = {
    "marriott": {},
    "paypal": {"Source": "https://jobsearch.paypal-corp.com/", "EmployerName": "PayPal"},
    "quest": {"Source": "Quest Diagnostics"},
    "lockheed": {"Source": "Lockheed Martin"},
    "careerjet": {"Source": "https://www.careerjet.co.in/jobs-in-india-83624.html"},
    "monster_sg": {"Source": " https://www.monster.com.sg", "Currency": "SGD - S$", "Location": "Singapore"},
    "cisco": {"Source": "Cisco"},
    "riteaid": {"Source": "https://careers.riteaid.com/jobs?page=1", "EmployerName": "RiteAid"},
    "mckesson": {},
}

# Item field -> canonical field. Several names mean the same.
SYNONYMS = {
    "Title": "title",
    "JobTitle": "title",
    "Description": "description",
    "JobDescription": "description",
    "JobURL": "job_url",
    "JobLink": "job_url",
    "ApplyLink": "apply_url",
    "JobApplyLink": "apply_url",
    "Source": "source",
    "EmployerName": "employer_name",
    "JobID": "job_id",
    "Location": "location",
    "EmploymentType": "employment_type",
    "EmploymentIndustry": "employment_industry",
    "JobFunction": "job_function",
    "Skills": "skills",
    "Experience": "experience",
    "Salary": "salary",
    "Currency": "currency",
    "PostedAt": "posted_raw",
}


def conform(df: DataFrame, schema: T.StructType = POSTING) -> DataFrame:
    """The declared columns in order and typed; absent ones null, undeclared ones an error."""
    unknown = set(df.columns) - set(schema.names)
    if unknown:
        raise ValueError(f"columns not declared: {sorted(unknown)}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def from_items(items: DataFrame, board: str) -> DataFrame:
    """An item-shaped table under canonical names. Text in a list or range field goes to
    a one-element list or to the raw column."""
    out: dict[str, Column] = {"source": F.lit(board)}
    for field in items.schema.fields:
        name = SYNONYMS.get(field.name)
        if name is None:
            raise ValueError(f"no canonical name for {field.name}")
        col = F.col(f"`{field.name}`")
        want = POSTING[name].dataType
        is_text = isinstance(field.dataType, T.StringType)
        if name in ("experience", "salary") and is_text:
            name += "_raw"
        elif isinstance(want, T.ArrayType) and is_text:
            col = F.when(col.isNotNull(), F.array(col))
        out[name] = col
    return conform(items.select(*[c.alias(n) for n, c in out.items()]))


def combine(tables: Iterable[DataFrame]) -> DataFrame:
    """One postings table from many; no shuffle."""
    return conform(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables))


def _first_text(items: Column) -> Column:
    return F.get(items, F.lit(0))


def item_view(postings: DataFrame, board: str) -> DataFrame:
    """A board's postings under the field names it declares, in declared order."""
    constant = CONSTANTS[board]
    stamp = dates.gmt_text(F.col("posted_at"), F.current_timezone())
    ranged = board == "monster_sg"
    values: dict[str, Column] = {
        name: F.col(canonical) for name, canonical in SYNONYMS.items() if canonical in postings.columns
    }
    values["EmploymentIndustry"] = (
        F.col("employment_industry") if board == "lockheed" else _first_text(F.col("employment_industry"))
    )
    values["JobFunction"] = (
        lists.bracketless(F.col("job_function")) if board == "marriott" else _first_text(F.col("job_function"))
    )
    values["PostedAt"] = F.coalesce(stamp, dates.reordered(F.col("posted_raw")), F.col("posted_raw"))
    if board == "marriott":
        values["PostedAt"] = F.col("posted_raw")
    values["Experience"] = F.col("experience") if ranged else F.col("experience_raw")
    values["Salary"] = F.col("salary") if ranged else F.col("salary_raw")
    values["Source"] = F.lit(constant.get("Source")).cast("string")
    if board == "monster_sg":
        values["JobID"] = F.col("job_id").try_cast("bigint")
        values["JobURL"] = F.lit(None).cast("string")
    return postings.select(
        *[values.get(name, F.lit(None).cast("string")).alias(name) for name in ITEM_FIELDS[board]]
    )
