"""Personal data: pattern spans, and terms that give a protected entity away.

All of it is DataFrame work. Base spans come from four patterns. Entities are the distinct
values they find. Terms are the words (runs of letters and digits, in lower case) outside base
spans. A term that stands in a document with an entity, however far off, is judged by how strongly
it reveals it over the whole corpus:

    disclosed = log2(P(entity | term) / P(entity)) / log2(1 / P(entity))

the pointwise mutual information of both as a share of the entity's information: 1 where
the term never occurs without the entity, 0 where they are independent. P(entity | term) is
the share of documents with the term that have the entity. Terms at or over `remove_at` are
removed, those at or over `generalise_at` replaced by a placeholder, wherever they stand, also
in documents without the entity. Both need `min_contexts` different surroundings of the entity,
so a text and its copies prove nothing.

Only words of documents with an entity in enough surroundings become candidates, and of those
only words rare enough to reach the lower limit. All counts fold before they are shuffled; no
group is collected but the entities and the terms to mark of one document.

Defined cases: a null text is empty; repeated rows each give their result (and count as
documents); an entity in every document has no information, so no term reveals it; an
empty table gives an empty result. Added columns take the place of input columns of their
names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm.columns import let, packed, unpacked
from hirelake.session import written

#: Fixed order of kinds in results; the last two are the method's.
KINDS = ("email", "ip", "card", "phone", "generalise", "remove")
#: Each pattern finds what the plain one finds, in time linear in the text: a match starts
#: at the head of a run of characters (or where the match before ended), never inside one.
PATTERNS = {
    "email": r"(?=[A-Za-z0-9._%+-])(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?=[0-9])(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?=[0-9])(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A text without the character has no match.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
IP_PARTS = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}$"
SPAN = "array<struct<kind:int,start:int,end:int,value:string>>"
#: Terms whose counts every task knows, and slots of the table of terms to mark: both bound what is
#: broadcast (a few MB), whatever the corpus has. They only spare rows; no result depends on them.
COMMON = 1 << 16
SLOTS = 1 << 18
#: What stands between terms.
BETWEEN = r"[^\p{L}\p{M}\p{N}]+"


@dataclass(frozen=True)
class Limits:
    """`reach`: characters on either side of an entity that are its surroundings;
    `min_letters`: shorter terms never count (1: there is no floor)."""

    reach: int = 64
    min_letters: int = 1
    min_contexts: int = 2
    generalise_at: float = 0.6
    remove_at: float = 0.85


def located(text: Column, pattern: str | Column, offset: Column | int = 0) -> Column:
    """Matches with their code points: array<struct<start, end, value>>, end exclusive.

    Gaps and matches alternate, so their lengths add up to positions."""

    def placed(found: Column, gaps: Column) -> Column:
        zero = F.struct(
            F.lit(offset).cast("int").alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out")
        )

        def step(acc: Column, i: Column) -> Column:
            start = acc["at"] + F.length(F.get(gaps, i))
            end = start + F.length(F.get(found, i))
            one = F.struct(start.alias("start"), end.alias("end"), F.get(found, i).alias("value"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), zero, step, lambda acc: acc["out"])

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return let(
        F.regexp_extract_all(text, F.lit(pattern) if isinstance(pattern, str) else pattern, F.lit(0)),
        lambda found: F.when(F.size(found) == 0, none).otherwise(let(F.split(text, pattern, -1), lambda gaps: placed(found, gaps))),
    )


def _luhn(digits: Column) -> Column:
    def worth(d: Column, i: Column) -> Column:
        double = d.cast("int") * 2
        return F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(double > 9, double - 9).otherwise(double))

    worths = F.transform(F.array_remove(F.split(F.reverse(digits), ""), ""), worth)
    return F.aggregate(worths, F.lit(0), lambda a, x: a + x) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(IP_PARTS)
    if kind == "card":
        return let(digits, _luhn)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Spans of the four base kinds, ordered by kind and start."""

    def of(kind: str) -> Column:
        found = F.filter(located(text, PATTERNS[kind]), lambda s: _passes(kind, s["value"]))
        out = F.transform(
            found,
            lambda s: F.struct(F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")),
        )
        may = F.contains(text, F.lit(NEEDS[kind])) if NEEDS[kind] else text.rlike("[0-9]")
        return F.when(may, out).otherwise(F.array().cast(SPAN))

    return F.concat(*(of(k) for k in KINDS[:4])).cast(SPAN)


def _entity(span: Column) -> Column:
    """The protected value: addresses in lower case, numbers as digits."""
    value = span["value"]
    plain = F.when(span["kind"] == 0, F.lower(value)).when(span["kind"] == 1, value).otherwise(F.regexp_replace(value, "[^0-9]", ""))
    return F.concat_ws(":", span["kind"].cast("string"), plain)


def _near(text: Column, span: Column, limits: Limits) -> Column:
    """struct<before, after, at>: the text on both sides without words cut by the reach."""
    start = F.greatest(span["start"] - limits.reach, F.lit(0))
    left = F.substring(text, start + 1, span["start"] - start)
    right = F.substring(text, span["end"] + 1, F.lit(limits.reach))
    whole = F.when(start > 0, F.regexp_replace(left, "^\\p{L}+", "")).otherwise(left)
    cut = F.when(F.length(right) == limits.reach, F.regexp_replace(right, "\\p{L}+$", "")).otherwise(right)
    return F.struct(whole.alias("before"), cut.alias("after"), (span["start"] - F.length(whole)).alias("at"))


def _masked(text: Column, spans: Column) -> Column:
    """The text with spaces in the place of base spans, so that positions stay."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        start = F.greatest(acc["at"], s["start"])
        gap = F.substring(text, acc["at"] + 1, start - acc["at"])
        piece = F.concat(acc["out"], gap, F.repeat(F.lit(" "), s["end"] - start))
        return F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(s["end"].alias("at"), piece.alias("out")))

    done = F.aggregate(ordered, zero, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(done)


def _entities(text: Column, spans: Column, limits: Limits) -> Column:
    """Each entity of the text once, with a hash of its surroundings."""

    def of(span: Column) -> Column:
        hashed = lambda near: F.xxhash64(F.lower(near["before"]), F.lower(near["after"]))
        return F.struct(_entity(span).alias("entity"), let(_near(text, span, limits), hashed).alias("context"))

    return let(
        F.array_sort(F.transform(spans, of)),
        lambda found: F.filter(found, lambda x, i: (i == 0) | (F.get(found, i - 1)["entity"] != x["entity"])),
    )


def _forms(masked: Column, limits: Limits) -> Column:
    """The different words as they are written."""
    return F.filter(F.array_distinct(F.split(masked, BETWEEN)), lambda w: F.length(w) >= limits.min_letters)


def _terms() -> Column:
    return F.array_distinct(F.transform("_forms", F.lower))


def _common(said: DataFrame) -> DataFrame:
    """(term, often) of the `COMMON` terms of most documents."""
    return said.orderBy(F.desc("with_term"), "term").limit(COMMON).select("term", F.col("with_term").alias("often"))


def _pairs(near: DataFrame, limits: Limits) -> DataFrame:
    """(number, term, both) of pairs in enough different surroundings. For one or two of them the least and
    the greatest tell, so pairs fold once; for more they are counted apart."""
    if limits.min_contexts <= 2:
        ends = near.groupBy("number", "term").agg(
            F.count("*").alias("both"), F.min("context").alias("low"), F.max("context").alias("high")
        )
        return ends.where((F.col("low") != F.col("high")) | F.lit(limits.min_contexts < 2)).drop("low", "high")
    apart = near.groupBy("number", "term", "context").agg(F.count("*").alias("docs"))
    pairs = apart.groupBy("number", "term").agg(F.sum("docs").alias("both"), F.count("*").alias("contexts"))
    return pairs.where(F.col("contexts") >= limits.min_contexts).drop("contexts")


def _scored(base: DataFrame, said: DataFrame, common: DataFrame, limits: Limits) -> DataFrame:
    """(term, disclosed) of the terms over the lower limit, by the entity that each reveals most.

    A term stands with an entity in no more documents than the entity has. So one in over
    with_entity^g * total^(1 - g) documents cannot disclose g of it, and is left out where it is
    known to be as common as that, before any pair is counted."""
    found = base.where(F.size("_spans") > 0).select("_forms", F.explode("_found").alias("e")).select("e.*", "_forms")
    contexts = written(found.groupBy("entity", "context").agg(F.count("*").alias("docs")), "contexts")
    total = base.agg(F.count("*").alias("total")).scalar()
    most = F.pow("with_entity", F.lit(limits.generalise_at)) * F.pow(total, F.lit(1 - limits.generalise_at))
    entities = written(
        contexts.groupBy("entity").agg(F.sum("docs").alias("with_entity"), F.count("*").alias("contexts"))
        .where(F.col("contexts") >= limits.min_contexts).drop("contexts")
        .select("*", F.monotonically_increasing_id().alias("number"), (most * (1 + 1e-9)).alias("most")),
        "entities",
    )
    near = found.join(entities, "entity").select("number", "most", "context", F.explode(_terms()).alias("term"))
    near = near.join(F.broadcast(common), "term", "left").where(F.coalesce(F.col("often") <= F.col("most"), F.lit(True)))
    share = F.log2(F.col("both") * total / (F.col("with_entity") * F.col("with_term")))
    whole = F.log2(total / F.col("with_entity"))
    return (
        _pairs(near, limits).join(entities, "number").join(said, "term")
        .withColumn("disclosed", F.when(whole > 0, share / whole).otherwise(F.lit(0.0)))
        .where(F.col("disclosed") >= limits.generalise_at)
        .groupBy("term").agg(F.max("disclosed").alias("disclosed"))
    )


def _slot(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(SLOTS)).cast("int")


def _marks(formed: DataFrame, scored: DataFrame, common: DataFrame) -> DataFrame:
    """(_row, _kinds): the words of each row to mark, as they are written, with their kinds. Common words
    not to mark, and others in slots without a term to mark, are left out where they are read; the terms
    decide on the rest."""
    words = formed.select("_row", F.explode("_forms").alias("form")).withColumn("term", F.lower("form"))
    spared = F.broadcast(written(common.join(scored, "term", "left_anti").select("term"), "spared"))
    taken = F.broadcast(scored.select(_slot(F.col("term")).alias("slot")).distinct())
    asked = words.join(spared, "term", "left_anti").withColumn("slot", _slot(F.col("term"))).join(taken, "slot", "left_semi")
    entry = F.struct("form", "kind")
    return asked.join(scored, "term").groupBy("_row").agg(F.map_from_entries(F.collect_list(entry)).alias("_kinds"))


def _marked(masked: Column, kinds: Column) -> Column:
    """Spans of all places of the words `kinds` (map of written form to kind)."""
    pattern = F.concat(
        F.lit(r"(?<![\p{L}\p{M}\p{N}])(?:"), F.array_join(F.map_keys(kinds), "|"), F.lit(r")(?![\p{L}\p{M}\p{N}])")
    )
    return F.transform(
        located(masked, pattern),
        lambda s: F.struct(
            F.try_element_at(kinds, s["value"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lower(s["value"]).alias("value")
        ),
    ).cast(SPAN)


def _clean(text: Column, spans: Column) -> Column:
    """The text with spans replaced: base spans and generalised terms by a placeholder, removed
    terms by nothing. Overlapping spans count once, the leftmost and longest first."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"), s["kind"].alias("kind"))))
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in (*KINDS[:4], "term")), F.lit(""))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(names, s["kind"]))
        return F.when(s["start"] < acc["at"], acc).otherwise(F.struct((-s["end"]).alias("at"), piece.alias("out")))

    return F.aggregate(ordered, zero, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def find(docs: DataFrame, text: str = "text", carry: list[str] | None = None, limits: Limits = Limits()) -> DataFrame:
    """Adds `spans` (array<struct<kind, start, end, value>>, by kind and start) to the columns
    `carry` (all unless named) and, where the text is carried, `clean_text`.

    The texts without base spans are written once, as counting and marking terms both read them."""
    carry = docs.columns if carry is None else carry
    whole = F.coalesce(F.col("_text"), F.lit(""))
    rows = packed(docs, carry, _text=F.col(text)).select("_in", "_text", base_spans(whole).alias("_spans"))
    base = written(
        rows.select(
            "_in", "_spans", F.when(F.size("_spans") > 0, _entities(whole, F.col("_spans"), limits)).alias("_found"),
            _masked(whole, F.col("_spans")).alias("_masked"), F.monotonically_increasing_id().alias("_row"),
        ),
        "spans",
    )
    formed = base.select("_row", "_spans", "_found", _forms(F.col("_masked"), limits).alias("_forms"))
    kind = F.when(F.col("disclosed") >= limits.remove_at, F.lit(5)).otherwise(F.lit(4))
    said = formed.select(F.explode(_terms()).alias("term")).groupBy("term").agg(F.count("*").alias("with_term"))
    said = written(said, "said")
    common = written(_common(said), "common")
    scored = written(_scored(formed, said, common, limits).select("term", kind.alias("kind")), "terms")
    extra = written(_marks(formed, scored, common), "marks")
    none = F.array().cast(SPAN)
    base = base.join(extra, "_row", "left").withColumn(
        "_more", F.when(F.col("_kinds").isNotNull(), _marked(F.col("_masked"), F.col("_kinds"))).otherwise(none)
    )
    out = base.withColumn("spans", F.array_sort(F.concat("_spans", "_more")))
    if text in carry:
        out = out.withColumn("_text", F.coalesce(F.col("_in")[text], F.lit("")))
        return unpacked(out.withColumn("clean_text", _clean(F.col("_text"), F.col("spans"))), carry, "spans", "clean_text")
    return unpacked(out, carry, "spans")
