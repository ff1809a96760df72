"""Pieces of checking SQL (DuckDB) that several queries share."""

# Written out here, not taken from the library, so that a wrong pattern there shows.
WHITESPACE = "".join(map(chr, (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)))
HREF = (
    r"""(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|"""
    r"""<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)"""
)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip_sql(x: str) -> str:
    return f"trim({x}, {quoted(WHITESPACE)})"


def host_sql(url: str) -> str:
    return f"lower(regexp_extract({url}, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1))"


def origin_sql(url: str) -> str:
    return f"regexp_extract({url}, '^[A-Za-z]+://[^/?#]+')"


def absolute_sql(href: str, base: str) -> str:
    return (
        f"case when regexp_matches({href}, '^[A-Za-z][A-Za-z0-9+.-]*:') then {href} "
        f"when starts_with({href}, '//') then 'https:' || {href} "
        f"else rtrim({base}, '/') || '/' || ltrim({href}, '/') end"
    )


def normalised_sql(url: str) -> str:
    bare = f"split_part({url}, '#', 1)"
    path = f"regexp_extract({bare}, '^[A-Za-z]+://[^/?]*([^?]*)', 1)"
    args = f"split_part({bare}, '?', 2)"
    return (
        f"lower({origin_sql(url)}) || case when {path} = '' then '/' else regexp_replace({path}, '/+', '/', 'g') end"
        f" || case when {args} = '' then '' else '?' || array_to_string(list_sort(string_split({args}, '&')), '&') end"
    )


_ANCHORS = (
    "list_transform(list_filter(regexp_extract_all(html, {p}, 1), lambda x: x <> ''), "
    "lambda x: replace(trim(x, '\"'''), '&amp;', '&'))"
).format(p=quoted(HREF))

# (page_id, url, n_links, pos, href), pos from 0
PAGE_LINKS = (
    "(select page_id, url, len(l) as n_links, cast(generate_subscripts(l, 1) - 1 as bigint) as pos, unnest(l) as href "
    f"from (select page_id, url, {_ANCHORS} as l from pages) t)"
)


def age_days_sql(posted: str) -> str:
    text = f"lower({strip_sql(f'''case when contains({posted}, ':') then split_part({posted}, ':', 2) else {posted} end''')})"
    n = f"coalesce(try_cast(regexp_extract({text}, '[0-9]+') as integer), 1)"
    return (
        f"case when {posted} is null then 0 when regexp_matches({text}, '\\b(just|today)\\b') then 0 "
        f"when regexp_matches({text}, '\\byesterday\\b') then 1 when regexp_matches({text}, '\\b(minute|hour)s?\\b') then 0 "
        f"when regexp_matches({text}, '\\bdays?\\b') then {n} when regexp_matches({text}, '\\bweeks?\\b') then {n} * 7 "
        f"when regexp_matches({text}, '\\bmonths?\\b') then {n} * 30 when regexp_matches({text}, '\\byears?\\b') then {n} * 365 "
        f"else {n} end"
    )
