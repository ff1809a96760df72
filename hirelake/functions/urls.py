"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:"
_SPLIT = "^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:[?]([^#]*))?"


def absolute(href: Column, base: str | Column) -> Column:
    """Absolute as is, `//host/x` gets https, anything else is put behind the base
    with exactly one slash."""
    prefix = F.lit(base) if isinstance(base, str) else base
    return (
        F.when(href.rlike(_SCHEME), href)
        .when(F.startswith(href, F.lit("//")), F.concat(F.lit("https:"), href))
        .otherwise(F.concat(F.rtrim(prefix, F.lit("/")), F.lit("/"), F.ltrim(href, F.lit("/"))))
    )


def slug_url(slug: Column, base: str) -> Column:
    return F.concat(F.lit(base), slug)


def host(url: Column) -> Column:
    """Lower-case host without user info and port; null when the URL has none."""
    found = F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.lower(found), F.lit(""))


def normalised(url: Column) -> Column:
    """Key for de-duplication: scheme and host lower-cased, fragment dropped, repeated
    slashes in the path merged, empty path made `/`, query arguments sorted."""
    scheme, authority, path, query = (F.regexp_extract(url, _SPLIT, i) for i in range(1, 5))
    path = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, "/+", "/"))
    query = F.array_join(F.array_sort(F.split(query, "&")), "&")
    key = F.concat(
        F.lower(scheme), F.lit("://"), F.lower(authority), path,
        F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)),
    )
    return F.when(url.rlike(_SPLIT), key).otherwise(F.split_part(url, F.lit("#"), F.lit(1)))


def host_suffixes(name: Column) -> Column:
    """a.b.c to [a.b.c, b.c, c]: every domain the host belongs to."""
    labels = F.split(name, "[.]")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
