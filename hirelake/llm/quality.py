"""Quality rules: word counts and repetition, then robust outliers per language and source.

All of it is DataFrame work. The statistics of a text are built-in functions over its
words; the minimum-covariance-determinant (MCD) fit is a fixed number of concentration
steps, each one aggregation. Sums are taken over whole numbers, so the fit does not
depend on the order of rows.

Fit. Every pair of language and source is fitted, whatever its size, and so are every language
and the whole. A step takes the share `share` of each group that lies nearest to the current
centre (whole distance bins, so ties stay together) and computes its mean and covariance; the
first step measures from coordinate medians. The rows of a group meet only in sums per group and
distance bin, whose number does not grow with the data.

Small groups. A document is judged by a mixture of its pair's estimate and its language's, which
is itself a mixture with that of the whole. Of n documents the own estimate weighs
n / (n + `pull`), so it moves smoothly from the wider group's to its own as the group grows.

Defined cases: null texts count as empty and fail; null languages and sources are groups
of their own; repeated rows count as often as they come; a table of one document is its own
centre, so it is kept if it passes the base rule; very long texts count as a whole, like others;
an empty table gives an empty result. Input columns are kept, except that an added
column takes the place of one of the same name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.columns import let, packed, unpacked, words
from hirelake.session import written

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
ADDED = (*STATS, "base_failed", "distance", "kept")
AXES = 4
#: Vectors are rounded to whole numbers of this unit.
UNIT = 10_000


@dataclass(frozen=True)
class Rules:
    """`floors`: the spread, per axis, that is never held against a document: log of the
    mean word length, and roots of the shares of symbols, repeated lines, repeated words.
    `pull`: documents of its own at which a group's estimate weighs as much as the wider one's.
    `reject`: probability that a clean document is farther out than the limit."""

    min_words: int = 50
    max_repeat_percent: int = 50
    pull: int = 30
    share: float = 0.75
    steps: int = 5
    reject: float = 0.001
    floors: tuple[float, float, float, float] = (0.08, 0.07, 0.25, 0.2)


def chi2_4(x: float) -> float:
    """Distribution function of chi-square with AXES degrees of freedom."""
    return 1 - math.exp(-x / 2) * (1 + x / 2)


def chi2_6(x: float) -> float:
    return 1 - math.exp(-x / 2) * (1 + x / 2 + x * x / 8)


def quantile(p: float) -> float:
    low, high = 0.0, 200.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_4(mid) < p else (low, mid)
    return high


def consistency(share: float) -> float:
    """What the covariance of the nearest `share` of normal data is short of."""
    return share / chi2_6(quantile(share))


def _repeated(hashes: Column) -> Column:
    """Words inside windows that come twice or more. Equal windows meet by sorting."""
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(s: Column) -> Column:
        same = lambda x, i, j: (j >= 0) & (j < F.size(s)) & (F.get(s, j)["h"] == x["h"])
        kept = F.transform(s, lambda x, i: F.when(same(x, i, i - 1) | F.coalesce(same(x, i, i + 1), F.lit(False)), x["i"]))
        return F.array_sort(F.filter(kept, lambda p: p.isNotNull()))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(3)), F.lit(3)))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    return let(pairs, lambda s: let(starts(s), covered)).cast("long")


def with_statistics(docs: DataFrame, text: str = "_text") -> DataFrame:
    """Adds STATS (long). Windows of three words are compared by 64-bit hashes within a text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    triples = F.transform(
        F.sequence(F.lit(0), F.size("_words") - 3),
        lambda i: F.xxhash64(*(F.get(F.col("_words"), i + k) for k in range(3))),
    )
    first = docs.withColumns({"_words": words(F.col(text)), "_lines": lines}).withColumns({
        "_triples": F.when(F.size("_words") >= 3, triples).otherwise(F.array().cast("array<bigint>")),
    })
    return first.select(
        *docs.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(F.regexp_replace(whole, "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("_triples")) == F.size("_triples"), F.lit(0).cast("long"))
        .otherwise(_repeated(F.col("_triples")))
        .alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
    )


def base_failed(rules: Rules) -> Column:
    return (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )


def _vector() -> list[Column]:
    """The transformed statistics in whole units; documents that passed the base rule have words."""
    share = lambda a, b: F.sqrt(F.col(a) / F.col(b))
    raw = [
        F.log(F.col("word_chars") / F.col("n_words")),
        share("n_symbols", "word_chars"),
        share("n_dup_lines", "n_lines"),
        share("n_repeat_words", "n_words"),
    ]
    return [F.round(x * UNIT).cast("long") for x in raw]


def _levels() -> list[Column]:
    """The groups a row belongs to, from the whole to its pair."""
    return [
        F.lit("0"),
        F.concat(F.lit("1"), F.to_json(F.struct("_lang"))),
        F.concat(F.lit("2"), F.to_json(F.struct("_lang", "_source"))),
    ]


def _cumulated(bins: DataFrame, sums: list[str], at: float, by: tuple = ("_group",)) -> DataFrame:
    """Per group, the sums over its lowest bins that together hold the share `at` of its rows."""
    up = Window.partitionBy(*by).orderBy("_bin")
    whole = Window.partitionBy(*by)
    out = bins.select(*by, "_bin", F.sum("_n").over(whole).alias("_all"), *(F.sum(c).over(up).alias(c) for c in sums))
    return out.where(F.col("_n") >= F.ceil(F.lit(at) * F.col("_all"))).withColumn(
        "_first", F.row_number().over(up)).where("_first = 1").drop("_first")


def _medians(rows: DataFrame) -> DataFrame:
    """The lower median of each axis to a hundredth, from counts per bin."""
    axes = rows.select("_group", F.posexplode(F.array(*(f"_x{k}" for k in range(AXES)))).alias("_axis", "_x"))
    counts = axes.groupBy("_group", "_axis", F.floor(F.col("_x") / 100).alias("_bin")).agg(F.count("*").alias("_n"))
    middle = F.col("_bin") * 100.0 + 50
    return _cumulated(counts, ["_n"], 0.5, ("_group", "_axis")).groupBy("_group").agg(
        *(F.max(F.when(F.col("_axis") == k, middle)).alias(f"_m{k}") for k in range(AXES)))


def _factored(fit: DataFrame) -> DataFrame:
    """Adds the Cholesky factor `_l..` of the covariance `_s..`."""
    for i in range(AXES):
        for j in range(i + 1):
            rest = F.col(f"_s{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"_l{i}{k}") * F.col(f"_l{j}{k}")
            fit = fit.withColumn(f"_l{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"_l{j}{j}"))
    return fit


def _first_fit(rows: DataFrame, rules: Rules) -> DataFrame:
    """Medians with the floors as spread."""
    fit = _medians(rows)
    for i in range(AXES):
        for j in range(i + 1):
            fit = fit.withColumn(f"_s{i}{j}", F.lit((rules.floors[i] * UNIT) ** 2 if i == j else 0.0))
    return _factored(fit)


def with_distance(rows: DataFrame, fit: DataFrame) -> DataFrame:
    """Adds `distance`, the squared Mahalanobis distance from the centre of the row's group."""
    out = rows.join(fit, "_group", "left")
    for i in range(AXES):
        z = F.col(f"_x{i}") - F.col(f"_m{i}")
        for k in range(i):
            z = z - F.col(f"_l{i}{k}") * F.col(f"_z{k}")
        out = out.withColumn(f"_z{i}", z / F.col(f"_l{i}{i}"))
    total = sum((F.col(f"_z{i}") * F.col(f"_z{i}") for i in range(AXES)), F.lit(0.0))
    return out.withColumn("distance", total).select(*rows.columns, "distance")


def _concentrated(rows: DataFrame, fit: DataFrame, rules: Rules) -> DataFrame:
    """One step: mean and covariance of the nearest share of each group."""
    pairs = [(i, j) for i in range(AXES) for j in range(i + 1)]
    exact = lambda c: F.sum(c.cast("decimal(25,0)"))
    bins = with_distance(rows, fit).groupBy(
        "_group", F.floor(F.log(F.col("distance") + 1e-6) * 32).alias("_bin")
    ).agg(
        F.count("*").alias("_n"),
        *(exact(F.col(f"_x{i}")).alias(f"_a{i}") for i in range(AXES)),
        *(exact(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"_b{i}{j}") for i, j in pairs),
    )
    sums = ["_n", *(f"_a{i}" for i in range(AXES)), *(f"_b{i}{j}" for i, j in pairs)]
    near, scale = _cumulated(bins, sums, rules.share), consistency(rules.share)
    n = F.col("_n").cast("double")
    means = {f"_m{i}": F.col(f"_a{i}").cast("double") / n for i in range(AXES)}
    spread = {}
    for i, j in pairs:
        inner = F.col(f"_b{i}{j}").cast("double") / n - F.col(f"_m{i}") * F.col(f"_m{j}")
        floor = (rules.floors[i] * UNIT) ** 2 if i == j else 0.0
        spread[f"_s{i}{j}"] = inner * scale + floor
    return _factored(near.withColumns(means).withColumns(spread)).drop(
        "_bin", *sums)


def fitted(rows: DataFrame, rules: Rules) -> DataFrame:
    """Centre, covariance and number of rows of each group; each step is written, so none is
    computed twice."""
    fit = written(_first_fit(rows, rules), "mcd")
    for _ in range(rules.steps):
        fit = written(_concentrated(rows, fit, rules), "mcd")
    return fit


def _drawn(fit: DataFrame, wider: DataFrame, rules: Rules) -> DataFrame:
    """The estimates of `fit` mixed with those of `wider`, which has them by `_wider`: mean and
    covariance of the two taken as one population, in shares of n to `pull`."""
    names = [f"_m{i}" for i in range(AXES)] + [f"_s{i}{j}" for i in range(AXES) for j in range(i + 1)]
    up = wider.select(F.col("_group").alias("_wider"), *(F.col(c).alias(f"{c}_up") for c in names))
    own = F.col("_all") / (F.col("_all") + F.lit(float(rules.pull)))
    mixed = lambda c: own * F.col(c) + (1 - own) * F.col(f"{c}_up")
    apart = lambda i: F.col(f"_m{i}") - F.col(f"_m{i}_up")
    return fit.join(up, "_wider").select(
        "_group", "_all",
        *(mixed(f"_m{i}").alias(f"_m{i}") for i in range(AXES)),
        *((mixed(f"_s{i}{j}") + own * (1 - own) * apart(i) * apart(j)).alias(f"_s{i}{j}") for i in range(AXES) for j in range(i + 1)),
    )


def shrunk(fit: DataFrame, parents: DataFrame, rules: Rules) -> DataFrame:
    """Estimates by which documents are judged: those of the pairs, drawn towards their languages',
    which are drawn towards the whole's. `parents`: `_group` of each pair and language, and its `_wider`."""
    linked = fit.drop(*(f"_l{i}{j}" for i in range(AXES) for j in range(i + 1))).join(parents, "_group")
    level = lambda k: F.col("_group").startswith(k)
    languages = _drawn(linked.where(level("1")), fit.where(level("0")), rules)
    return _factored(_drawn(linked.where(level("2")), languages, rules)).drop("_all")


def score(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    carry: list[str] | None = None, rules: Rules = Rules(),
) -> DataFrame:
    """Adds ADDED to the columns `carry` (all of them unless named) of each row of `docs`.

    `kept` is false where `base_failed` is true, else where `distance` is over the limit.
    The statistics are written once; texts are read again only if they are carried."""
    carry = docs.columns if carry is None else carry
    rows = packed(docs, carry, _text=F.col(text), _lang=F.col(lang), _source=F.col(source))
    stats = with_statistics(rows).drop("_text").withColumn("base_failed", base_failed(rules))
    stats = stats.withColumns({f"_x{i}": F.when(~F.col("base_failed"), x) for i, x in enumerate(_vector())})
    stats = written(stats, "statistics")
    # Written tables have a known size: small ones are broadcast, and rows with texts stay where they are.
    root, language, pair = _levels()
    vectors = stats.where(~F.col("base_failed")).select(
        F.explode(F.array(root, language, pair)).alias("_group"), *(f"_x{i}" for i in range(AXES)))
    # Three rows a document, made once: every step of the fit reads them.
    fit_on = written(vectors, "vectors")
    known = stats.where(~F.col("base_failed")).select(language.alias("_one"), pair.alias("_two")).distinct()
    links = F.array(*(F.struct(F.col(a).alias("_group"), b.alias("_wider")) for a, b in (("_one", root), ("_two", F.col("_one")))))
    parents = known.select(F.inline(links)).distinct()
    fit = written(shrunk(fitted(fit_on, rules), parents, rules), "mcd")
    far = F.coalesce(F.col("distance") > quantile(1 - rules.reject), F.lit(False))
    out = with_distance(stats.withColumn("_group", pair), fit).withColumn("kept", ~F.col("base_failed") & ~far)
    return unpacked(out, carry, *ADDED)


def kept(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", rules: Rules = Rules()) -> DataFrame:
    """The rows of `docs` that the rules keep, with their columns."""
    whole = score(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), text, lang, source), text, lang, source, ["row"], rules)
    return whole.where("kept").select("row.*")
