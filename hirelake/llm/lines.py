"""Line dedup within one edit, by a deletion-neighbourhood join.

A line is a piece of a text between line feeds; it is compared in lower case with white space
at its ends and in runs folded. A line is removed if a line that is equal, or differs by one
character replaced, inserted or deleted, stands earlier: in a document with a smaller id, or
further up in the same one. Equal lines of any length count; one edit is allowed where both lines
have `min_chars` characters, as in shorter ones a single character makes another word. Lines
are judged on the input, not on what is left.

Equal lines are folded first, to their earliest place. Then every different line would emit
its variants: itself, and itself without each one of its characters, hashed. To emit few, a
filter goes before it that loses no pair: of two lines within one edit, one half is untouched,
so only lines that share the first or the last half of that length with another line can have
a partner. Partners meet by variants in two ways. Lines that give the same variant by deleting
at the same place differ by a replacement, so all of them are within one edit of each other;
a line that is another's variant differs from it by one deletion. Both ways need only the
earliest line of a group, a minimum that folds before the shuffle; pairs of a group are never
made. The edit distance to that earliest line is verified.

Defined cases: null texts have no lines and stay null; blank lines stay; documents whose
id is null come after all others; rows of one id come in the order of their texts' digests;
rows equal in id and text are one place, so all of them keep or lose the same lines; an empty
table gives an empty result. A document keeps its row even if no line is left; its text is
then empty. Added columns take the place of input columns of their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.columns import bit_table, packed, returned, unpacked
from hirelake.llm.rolling import Rolling, mixed
from hirelake.session import written

#: Characters from which a line may differ by an edit from one that it repeats.
MIN_CHARS = 20
#: Slots of the table of lines that may have a partner (16 MB in a task), whatever their number.
TABLE_BITS = 1 << 24


def normal(line: str) -> str:
    """What lines are compared by."""
    return " ".join(line.lower().split())


def line_hash(line: str) -> tuple[int, int]:
    """128 bits, as two signed numbers."""
    import xxhash

    both = np.frombuffer(xxhash.xxh3_128_digest(line.encode()), dtype="<i8")
    return int(both[0]), int(both[1])


def half_keys(line: str) -> list[int]:
    """What a line shares with every line within one edit: the first or the last half, taken of
    its own length or of one less, as the shorter of the two has it."""
    import xxhash

    out = []
    for shorter in (len(line), len(line) - 1):
        half = (shorter - 1) // 2
        for side, part in (("<", line[:half]), (">", line[len(line) - half :])):
            out.append(xxhash.xxh3_64_intdigest(f"{side}{shorter}:{part}".encode()) - (1 << 63))
    return out


def _lines(texts: pa.Array) -> Iterator[tuple[int, int, str]]:
    for row, text in enumerate(texts.to_pylist()):
        for at, line in enumerate(text.split("\n") if text else ()):
            if plain := normal(line):
                yield row, at, plain


def _hashed(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text")
            ties = [
                int.from_bytes(hashlib.sha256(t.as_py() or b"").digest()[:8], "big", signed=True)
                for t in texts.cast(pa.binary())
            ]
            rows, places, hashes, halves, short = [], [], [], [], []
            for row, at, plain in _lines(texts):
                rows.append(row)
                places.append(at)
                hashes.append(line_hash(plain))
                short.append(len(plain) < min_chars)
                halves.append((0, 0, 0, 0) if short[-1] else half_keys(plain))
            h = np.array(hashes, dtype=np.int64).reshape(-1, 2)
            k, none = np.array(halves, dtype=np.int64).reshape(-1, 4), np.array(short, dtype=bool)
            own = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id").take(own), pa.array(ties, pa.int64()).take(own), pa.array(places, pa.int32()),
                    pa.array(h[:, 0]), pa.array(h[:, 1]), *(pa.array(k[:, i], mask=none) for i in range(4)),
                ],
                ["id", "tie", "line", "h1", "h2", "k0", "k1", "k2", "k3"],
            )

    return run


def _texts_of(min_chars: int, table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value
        for batch in batches:
            found = {}
            for _, _, plain in _lines(batch.column("_text")):
                if len(plain) < min_chars:
                    continue
                h = line_hash(plain)
                if bits[h[0] & TABLE_BITS - 1]:
                    found[h] = plain
            yield pa.RecordBatch.from_arrays(
                [pa.array([h[0] for h in found], pa.int64()), pa.array([h[1] for h in found], pa.int64()), pa.array(list(found.values()), pa.string())],
                ["h1", "h2", "plain"],
            )

    return run


def variants(line: str, rolling: Rolling) -> np.ndarray:
    """Hashes of the line and of the line without each of its characters, each in O(1)."""
    letters = np.frombuffer(line.encode("utf-32-le"), dtype=np.uint32)
    sums = rolling.prefix(letters)
    without = sums[:-1] + (sums[-1] - sums[1:]) * rolling.down[1]
    return mixed(np.concatenate((sums[-1:], without)))


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rolling = Rolling(1 << 12)
    for batch in batches:
        for cid, plain in zip(batch.column("cid").to_pylist(), batch.column("plain").to_pylist()):
            made = variants(plain, rolling)
            yield pa.RecordBatch.from_arrays(
                [pa.array(made.view(np.int64)), pa.array(np.arange(-1, len(made) - 1, dtype=np.int32)), pa.array(np.full(len(made), cid))],
                ["variant", "pos", "cid"],
            )


def _partners(candidates: DataFrame) -> DataFrame:
    """(cid, best) where an earlier line within one edit exists; best is the earliest place of
    one. `candidates`: cid, place, plain."""
    keys = candidates.select("cid", "plain").mapInArrow(returned(_variants), "variant long, pos int, cid long")
    met = keys.withColumn("n", F.count("*").over(Window.partitionBy("variant"))).where("n >= 2").drop("n")
    # Spark takes a line's variants for one row, and stored texts and runs of equal values for what they take on disk.
    # So that none of these is broadcast, the first join, which finds every cid, is an outer one; others are merge joins.
    met = written(met.join(candidates.select("cid", "place"), "cid", "left").withColumn("one", F.struct("place", "cid")), "variants")
    shorter, longer = met.where("pos < 0").select("variant", "one"), met.where("pos >= 0")
    replaced = longer.hint("merge").join(longer.groupBy("variant", "pos").agg(F.min("one").alias("other")), ["variant", "pos"])
    added = longer.join(shorter.withColumnRenamed("one", "other"), "variant")
    dropped = shorter.join(longer.groupBy("variant").agg(F.min("one").alias("other")), "variant")
    pairs = replaced.select("one", "other").union(added.select("one", "other")).union(dropped.select("one", "other"))
    pairs = pairs.where("other.place < one.place").select(
        F.col("one.cid").alias("cid"), F.col("other.cid").alias("other"), F.col("other.place").alias("place")
    ).distinct()
    own, its = candidates.select("cid", "plain"), candidates.select(F.col("cid").alias("other"), F.col("plain").alias("its"))
    near = pairs.join(own.hint("merge"), "cid").join(its.hint("merge"), "other").where(F.levenshtein("plain", "its", 1) >= 0)
    return near.groupBy("cid").agg(F.min("place").alias("best"))


def _tie(text: Column) -> Column:
    """The first eight bytes of the text's SHA-256, signed."""
    head = F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 16)
    high = F.conv(F.substring(head, 1, 8), 16, 10).cast("long")
    return F.shiftleft(high, 32).bitwiseOR(F.conv(F.substring(head, 9, 8), 16, 10).cast("long"))


def _removed(rows: DataFrame, min_chars: int) -> DataFrame:
    """(id, tie, lines): numbers of the lines to remove."""
    kind = rows.schema["_id"].dataType.simpleString()
    lines = written(
        rows.select("_id", "_text").mapInArrow(
            _hashed(min_chars), f"id {kind}, tie long, line int, h1 long, h2 long, k0 long, k1 long, k2 long, k3 long"
        ).withColumn("place", F.struct(F.col("id").isNull().alias("none"), "id", "tie", "line")).drop("id", "tie", "line"),
        "lines",
    )
    halves = [f"k{i}" for i in range(4)]
    distinct = written(
        lines.groupBy("h1", "h2").agg(
            F.min("place").alias("first"), F.count("*").alias("n"), *(F.min(k).alias(k) for k in halves)
        ),
        "distinct-lines",
    )
    keys = distinct.where("k0 is not null").select("h1", "h2", F.explode(F.array(*halves)).alias("half"))
    common = written(keys.groupBy("half").agg(F.count("*").alias("n")).where("n >= 2").select("half"), "halves")
    possible = written(keys.join(common, "half", "left_semi").select("h1", "h2").distinct(), "possible-lines")
    table = rows.sparkSession.sparkContext.broadcast(bit_table(possible, "h1", TABLE_BITS))
    texts = rows.select("_text").mapInArrow(returned(_texts_of(min_chars, table)), "h1 long, h2 long, plain string")
    texts = texts.groupBy("h1", "h2").agg(F.first("plain").alias("plain"))
    candidates = written(
        texts.join(possible, ["h1", "h2"], "left_semi").join(distinct.select("h1", "h2", F.col("first").alias("place")), ["h1", "h2"])
        .withColumn("cid", F.monotonically_increasing_id()),
        "candidates",
    )
    partners = written(
        _partners(candidates).join(candidates.select("cid", "h1", "h2"), "cid").select("h1", "h2", "best"), "partners"
    )
    earliest = (
        distinct.select("h1", "h2", "first", "n").join(partners, ["h1", "h2"], "left").where("n > 1 or best is not null")
        .select("h1", "h2", F.least("first", F.coalesce("best", "first")).alias("earliest"))
    )
    gone = lines.select("h1", "h2", "place").hint("merge").join(earliest, ["h1", "h2"]).where("earliest < place")
    return gone.groupBy("place.id", "place.tie").agg(F.collect_set("place.line").alias("lines"))


def _cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, lines in batches:
        out = []
        for text, gone in zip(texts.to_pylist(), lines.to_pylist()):
            gone = set(gone or ())
            out.append(None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone))
        yield pa.array(out, pa.string())


def dedupe(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", carry: list[str] | None = None,
           min_chars: int = MIN_CHARS) -> DataFrame:
    """Adds `kept_text` (the text without removed lines) and `n_removed` to the columns `carry`,
    all of them unless named."""
    carry = docs.columns if carry is None else carry
    rows = packed(docs, carry, _text=F.col(text), _id=F.col(doc_id))
    gone = written(_removed(rows, min_chars), "removed-lines").select(F.col("id").alias("_gone_id"), F.col("tie").alias("_tie"), "lines")
    joined = rows.withColumn("_tie", _tie(F.col("_text"))).join(
        gone.withColumnRenamed("_tie", "_gone_tie"), (F.col("_tie") == F.col("_gone_tie")) & F.col("_id").eqNullSafe(F.col("_gone_id")), "left"
    )
    cut = F.arrow_udf(_cut, "string")(F.when(F.col("lines").isNotNull(), F.col("_text")), F.col("lines"))
    out = joined.select(
        "_in", F.when(F.col("lines").isNotNull(), cut).otherwise(F.col("_text")).alias("kept_text"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_removed"),
    )
    return unpacked(out.withColumn("n_removed", F.greatest("n_removed", F.lit(0).cast("long"))), carry, "kept_text", "n_removed")


def deduped(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = MIN_CHARS) -> DataFrame:
    """`docs` with the removed lines cut out of its text."""
    rest = [c for c in docs.columns if c != text]
    whole = F.struct(*(F.col(f"`{c}`") for c in rest)).alias("row")
    named = docs.select(whole, F.col(text).alias("text"), F.col(doc_id).alias("id"))
    made = dedupe(named, "text", "id", ["row"], min_chars)
    return made.select(*(F.col("kept_text").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns))
