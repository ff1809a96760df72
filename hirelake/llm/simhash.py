"""Near-duplicates by SimHash: fingerprints of 64 bits, linked at few differing bits.

Candidates come from an inverted index over the bytes of fingerprints at their positions.
Fingerprints within `bits` differing bits differ in at most `bits` of the eight bytes, so they
share at least 8 - `bits` of them: the guaranteed minimum. Lists of single bytes would make
tallies for every 32nd pair, so a list is kept for each choice of that many positions
together: two fingerprints are in one list exactly if their tally reaches the minimum. The
tally is then counted for the pairs of a list, and pairs that reach it are verified.

Equal fingerprints are folded first. Lists are counted, which folds in every task. Those of one
member are left out; those longer than `BLOCK` are dealt by hash to blocks of about that size,
and every two blocks meet in a group of their own, so no long list is ever in one task as a
whole. Pairs are compared inside the task, which returns one link per member to the least one
that it is connected to within the group, never the pairs. Components of the links are then the
components of all pairs.

Defined cases: a text without words (null, empty) has fingerprint zero, linked like any
other; a null id is never the least of a component (one of nulls only has null); repeated
rows each give their result; an empty table gives an empty result. Added columns take the
place of input columns of their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.columns import packed, returned, unpacked
from hirelake.llm.components import components
from hirelake.session import written

SHINGLE = 4
SEED = 42
BITS = 4
#: Members of a list from which it is dealt to blocks.
BLOCK = 512
#: Hashes whose bits are counted at once.
COUNTED = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 of all shingles of words, repeats included; zero without words."""
    import xxhash

    whole = b" ".join(text.lower().split())
    if not whole:
        return 0
    gaps = np.flatnonzero(np.frombuffer(whole, dtype=np.uint8) == 32)
    starts, ends = np.concatenate(([0], gaps + 1)), np.append(gaps, len(whole))
    if len(starts) > shingle:
        starts, ends = starts[: len(starts) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, set_bits = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), COUNTED):
        pairs = zip(starts[at : at + COUNTED].tolist(), ends[at : at + COUNTED].tolist())
        hashes = np.array([digest(whole[s:e], SEED) for s, e in pairs], dtype=np.uint64)
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << b for b in np.flatnonzero(2 * set_bits > len(starts)).tolist())


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            prints = [fingerprint(t.as_py() or b"", shingle) for t in texts.cast(pa.binary())]
            yield pa.array(np.array(prints, dtype=np.uint64).view(np.int64))

    return run


def forest(prints: np.ndarray, first: np.ndarray, sizes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Groups lie one after another; `first` is each row's place in its group and `sizes` the
    size of it. Returns links (member, least connected member) as row numbers."""
    roots = np.arange(len(prints))
    lows, highs = [], []
    step, rows = 1, np.arange(len(prints))
    while True:
        rows = rows[first[rows] + step < sizes[rows]]
        if not len(rows):
            break
        apart = prints[rows] ^ prints[rows + step]
        # The tally: bytes at the same position that are equal.
        tally = (apart.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        near = rows[(tally >= 8 - bits) & (np.bitwise_count(apart) <= bits)]
        lows.append(near)
        highs.append(near + step)
        step += 1
    if not lows:
        return roots[:0], roots[:0]
    low, high = np.concatenate(lows), np.concatenate(highs)
    while True:
        least = np.minimum(roots[low], roots[high])
        before = roots.copy()
        np.minimum.at(roots, low, least)
        np.minimum.at(roots, high, least)
        roots = roots[roots]
        if np.array_equal(roots, before):
            break
    member = np.flatnonzero(roots != np.arange(len(roots)))
    return member, roots[member]


def _links(bits: int):
    """Rows sorted by group to links; groups are short, and only whole ones are handled together."""
    keys = ("choice", "key", "i", "j")

    def handle(cols: dict[str, np.ndarray]) -> pa.RecordBatch:
        n = len(cols["print"])
        new = np.ones(n, dtype=bool)
        new[1:] = np.logical_or.reduce([cols[k][1:] != cols[k][:-1] for k in keys])
        starts = np.flatnonzero(new)
        lengths = np.diff(np.append(starts, n))
        first = np.arange(n) - np.repeat(starts, lengths)
        member, root = forest(cols["print"], first, np.repeat(lengths, lengths), bits)
        prints = cols["print"].view(np.int64)
        links = np.unique(np.stack([prints[member], prints[root]], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        for batch in batches:
            cols = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in (*keys, "print")}
            cols["print"] = cols["print"].astype(np.int64).view(np.uint64)
            if held:
                cols = {c: np.concatenate([held[c], cols[c]]) for c in cols}
            n = len(cols["print"])
            if not n:
                continue
            last = np.flatnonzero(np.logical_or.reduce([cols[k] != cols[k][-1] for k in keys]))
            cut = int(last[-1]) + 1 if len(last) else 0
            held = {c: v[cut:] for c, v in cols.items()}
            if cut:
                yield handle({c: v[:cut] for c, v in cols.items()})
        if held and len(held["print"]):
            yield handle(held)

    return run


def links(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """(a, b) of fingerprints (column `print`, long, distinct) whose components are those of all
    pairs within `bits` differing bits."""
    if not 0 <= bits <= 7:
        raise ValueError("bits must be 0 to 7: with more, fingerprints need not share a byte")
    masks = [sum(0xFF << 8 * p for p in c) for c in combinations(range(8), 8 - bits)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    choices = F.array(*(F.struct(F.lit(i).alias("choice"), F.lit(m).cast("long").alias("mask")) for i, m in enumerate(signed)))
    index = prints.select("print", F.explode(choices).alias("c")).select(
        "print", F.col("c.choice").alias("choice"), F.col("print").bitwiseAND(F.col("c.mask")).alias("key")
    )
    lists = index.groupBy("choice", "key").agg(F.count("*").alias("n")).where("n >= 2").select(
        "choice", "key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")
    )
    # A row per print and choice: Spark sizes them as if `explode` added no rows, and would broadcast them.
    placed = index.hint("merge").join(lists, ["choice", "key"])
    own = F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int").alias("own")
    others = F.explode(F.sequence(F.lit(0), F.greatest(F.col("blocks") - 2, F.lit(0)))).alias("k")
    grouped = placed.select("choice", "key", "print", "blocks", own, others)
    other = F.when(F.col("blocks") == 1, F.col("own")).when(F.col("k") >= F.col("own"), F.col("k") + 1).otherwise(F.col("k"))
    grouped = grouped.select("choice", "key", F.least("own", other).alias("i"), F.greatest("own", other).alias("j"), "print")
    keys = ["choice", "key", "i", "j"]
    dealt = grouped.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(returned(_links(bits)), "a long, b long").distinct()


def cluster(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", carry: list[str] | None = None,
            shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """Adds `fingerprint` (long), `component_id` (least id of the component) and `keeper` (true for
    one row of each component: the least id, nulls last) to the columns `carry`, all unless named."""
    carry = docs.columns if carry is None else carry
    udf = F.arrow_udf(_fingerprints(shingle), "long")
    rows = packed(docs, carry, _text=F.col(text), _id=F.col(doc_id))
    rows = written(
        rows.select("_in", "_id", udf("_text").alias("fingerprint"), F.monotonically_increasing_id().alias("_row")), "prints"
    )
    order = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    prints = written(rows.groupBy(F.col("fingerprint").alias("print")).agg(F.min(order).alias("least")), "distinct-prints")
    found = components(links(prints.select("print"), bits))
    placed = prints.join(found, F.col("print") == F.col("node"), "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    least = placed.groupBy("root").agg(F.min("least").alias("best"))
    known = placed.join(least, "root").select(F.col("print").alias("fingerprint"), "best")
    out = rows.join(written(known, "components"), "fingerprint").select(
        "_in", "fingerprint", F.col("best.id").alias("component_id"), (F.col("_row") == F.col("best.row")).alias("keeper")
    )
    return unpacked(out, carry, "fingerprint", "component_id", "keeper")


def kept(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """One row of `docs` per component, with its columns."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    named = docs.select(whole, F.col(text).alias("text"), F.col(doc_id).alias("id"))
    return cluster(named, "text", "id", ["row"], shingle, bits).where("keeper").select("row.*")
