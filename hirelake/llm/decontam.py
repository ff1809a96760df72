"""Benchmark decontamination by winnowing.

Texts become words. Of every `window` consecutive words the least hash of their runs of
`GRAM` words is a fingerprint, so two texts that share a window share a fingerprint inside it.
Fingerprints of documents and items are joined, and each hit is extended word by word in both
directions; it counts where it reaches a whole window. A fingerprint carries the few words on
either side that any window around it can reach, so hits are extended without reading a
text again. Items of fewer words than a window are one window of their own, compared whole.

A bit table of fixed size, made from the items' fingerprints, keeps those of documents that no
item can have from leaving their task; it drops nothing else, and however many items there
are, the join decides.

Defined cases: null texts have no words; an item without words is never found; items of equal
id count once, those without id together as one; repeated documents each give their result;
empty tables give no hits. Added columns take the place of input columns of their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.columns import bit_table, packed, returned, unpacked
from hirelake.llm.rolling import Rolling, blocks, mixed
from hirelake.llm.wordruns import Words
from hirelake.session import written

WINDOW = 10
#: Words in a run; a window has WINDOW - GRAM + 1 of them.
GRAM = 5
#: Slots of the bit table (16 MB in a task), whatever the number of items.
TABLE_BITS = 1 << 24
#: Bytes that separate words; letters are lowered first.
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
PLAIN = bytes.maketrans(
    SEPARATORS + bytes(range(0x41, 0x5B)), b" " * len(SEPARATORS) + bytes(range(0x61, 0x7B))
)
HIT = "struct<fp:long,pos:int,low:int,near:string>"


def normal(text: bytes) -> bytes:
    """The words in lower case, one space between them."""
    return b" ".join(text.translate(PLAIN).split())


def sized(hashes: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of whole windows of `size` words, apart from those of runs."""
    return mixed(hashes + np.uint64(size))


def _slots(fps: np.ndarray) -> np.ndarray:
    return (fps % np.uint64(TABLE_BITS)).astype(np.int64)


def _found(words: Words, window: int, sizes: list[int], bits: np.ndarray | None):
    """(text, fingerprint, place, size, reach) of all fingerprints that the table has."""
    for size in [window, *sizes]:
        if size == window:
            (places, fps), size, reach = words.winnowed(window, GRAM), GRAM, window - GRAM
        else:
            hashes, whole = words.runs(size)
            places, reach = np.flatnonzero(whole), 0
            fps = sized(hashes[places], size)
        if bits is not None:
            keep = bits[_slots(fps)]
            places, fps = places[keep], fps[keep]
        for place, fp in zip(places.tolist(), fps.view(np.int64).tolist()):
            yield int(words.text[place]), fp, place, size, reach


def _items(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for batch in batches:
            rows = []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                words = Words([normal(text or b"")], rolling)
                n = len(words.starts)
                if n == 0:
                    continue
                sizes = [n] if n < window else []
                for _, fp, place, size, reach in _found(words, window, sizes, None):
                    pos, low, near = words.near(place, size, reach)
                    rows.append({"fp": fp, "item": item, "size": n if n < window else 0, "at": pos - low, "words": near})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                ("fp", pa.int64()), ("item", batch.schema.field("item").type), ("size", pa.int32()),
                ("at", pa.int32()), ("words", pa.string()),
            ]))

    return run


def _documents(window: int, sizes: list[int], table):
    kind = pa.list_(pa.struct([("fp", pa.int64()), ("pos", pa.int32()), ("low", pa.int32()), ("near", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, bits = Rolling(), table.value
        for batch in batches:
            texts = [normal(t.as_py() or b"") for t in batch.column("_text").cast(pa.binary())]
            hits: list[list] = [[] for _ in texts]
            counts = []
            for a, b in blocks([len(t) for t in texts]):
                words = Words(texts[a:b], rolling)
                counts.append(words.counts)
                for text, fp, place, size, reach in _found(words, window, sizes, bits):
                    pos, low, near = words.near(place, size, reach)
                    hits[a + text].append({"fp": fp, "pos": pos, "low": low, "near": near})
            n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("_in"), pa.array(n, pa.int64()), pa.array(hits, kind)], ["_in", "n_words", "hits"])

    return run


def extended(near: list[str], at: int, item: list[str], item_at: int, size: int, window: int) -> tuple[int, int] | None:
    """The words of `near` that agree with the item's around the run at `at`, if a window of them does."""
    if size:
        return (at, at + size) if near == item else None
    if near[at : at + GRAM] != item[item_at : item_at + GRAM]:
        return None
    left = 0
    while left < min(at, item_at) and near[at - left - 1] == item[item_at - left - 1]:
        left += 1
    right = GRAM
    while at + right < len(near) and item_at + right < len(item) and near[at + right] == item[item_at + right]:
        right += 1
    return (at - left, at + right) if left + right >= window else None


def _extender(window: int):
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for cols in batches:
            out = []
            for pos, low, near, at, words, size in zip(*(c.to_pylist() for c in cols)):
                span = extended(near.split(" "), pos - low, words.split(" "), at, size, window)
                out.append(span and {"start": low + span[0], "end": low + span[1]})
            yield pa.array(out, pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    return run


def check(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    carry: list[str] | None = None, window: int = WINDOW,
) -> DataFrame:
    """Adds `n_words`, `n_hit` (words inside found windows), `n_items`, `items` (ids as strings, sorted)
    and `contaminated` to the columns `carry` of each row of `docs`, all of them unless named."""
    if window <= GRAM:
        raise ValueError(f"a window has more than {GRAM} words")
    spark = docs.sparkSession
    carry = docs.columns if carry is None else carry
    kind = items.schema[item_id].dataType.simpleString()
    prints = written(
        items.select(F.col(item_id).alias("item"), F.col(item_text).alias("text")).mapInArrow(
            _items(window), f"fp long, item {kind}, size int, at int, words string"
        ),
        "item-prints",
    )
    # At most window - 1 sizes.
    sizes = sorted(r["size"] for r in prints.where("size > 0").select("size").distinct().collect())
    table = spark.sparkContext.broadcast(bit_table(prints, "fp", TABLE_BITS))
    rows = packed(docs, carry, _text=F.col(text))
    shape = rows.schema["_in"].dataType.simpleString()
    marked = rows.mapInArrow(returned(_documents(window, sizes, table)), f"_in {shape}, n_words long, hits array<{HIT}>")
    marked = written(marked.withColumn("_row", F.monotonically_increasing_id()), "document-prints")

    hits = marked.where(F.size("hits") > 0).select("_row", F.explode("hits").alias("h")).select("_row", "h.*")
    span = F.arrow_udf(_extender(window), "struct<start:int,end:int>")("pos", "low", "near", "at", "words", "size")
    spans = written(
        hits.join(prints, "fp").select("_row", "item", span.alias("s")).where("s is not null")
        .select("_row", "item", "s.start", "s.end").distinct(),
        "leaks",
    )
    covered = (
        spans.select("_row", "start", "end").distinct()
        .select("_row", F.explode(F.sequence("start", F.col("end") - 1)).alias("word")).distinct()
        .groupBy("_row").agg(F.count("*").alias("n_hit"))
    )
    found = (
        spans.select("_row", "item").distinct().groupBy("_row")
        .agg(F.count("*").alias("n_items"), F.sort_array(F.collect_list(F.col("item").cast("string"))).alias("items"))
    )
    zero = F.lit(0).cast("long")
    # Written, its size is known: a small table is broadcast, and rows with texts stay where they are.
    leaks = written(covered.join(found, "_row"), "leaks-per-row")
    out = marked.select("_row", "_in", "n_words").join(leaks, "_row", "left").select(
        "_in", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.col("n_hit").isNotNull().alias("contaminated"),
    )
    return unpacked(out, carry, "n_words", "n_hit", "n_items", "items", "contaminated")


def kept(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
         window: int = WINDOW) -> DataFrame:
    """The rows of `docs` without any window of an item, with their columns."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    named = docs.select(whole, F.col(text).alias("text"))
    return check(named, items, "text", item_id, item_text, ["row"], window).where(~F.col("contaminated")).select("row.*")
