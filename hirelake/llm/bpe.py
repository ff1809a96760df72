"""BPE encoding with content-defined chunk reuse, and decoding.

A rolling hash over the last bytes cuts each text into chunks, so the same passage is cut
alike wherever it stands. Chunks that occur twice or more in the corpus are encoded once,
into a dictionary table keyed by a digest; all other chunks are encoded where they stand.
A cut may fall inside a word. Each join is then repaired: the words around it are encoded
again together with more and more of their neighbours, until the tokens of the outermost
ones agree with those the chunks have.

Flow: count chunk hashes (folded per task), turn the repeated ones into a bit table of
fixed size, collect one text per repeated chunk and encode it, then encode the documents.
Documents without a repeated chunk are finished where they are read; only the others join
the dictionary and are put together again. A false positive of the bit table only adds an
entry to the dictionary.

The tokenizer must drop white space between words, which `Codec` checks; its words are then
independent of each other, and their tokens are kept in a cache of bounded size, one for each
Python worker, so the tasks that follow each other in a worker share it. What a caller derives
from the ids is made in that worker too (`each`): a second Python step would be a second
worker per core, and as workers change places, each would come to hold such a cache.

Defined cases: a null text is empty and has no tokens; repeated rows each give their
result; special tokens written in a text are encoded as such, as the library does; an empty
table gives an empty result; a text at one of whose joins no neighbourhood agrees is encoded whole;
very long texts are cut into chunks like others. Token ids are packed as little-endian unsigned integers of
`id_bytes` bytes. The added column takes the place of an input column of its name.
"""

from __future__ import annotations

import functools
import hashlib
import importlib.util
import json
import os
from collections.abc import Callable, Iterator
from itertools import accumulate, chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm.columns import bit_table, packed, returned, unpacked
from hirelake.llm.rolling import Rolling, blocks
from hirelake.session import written

#: Bytes the rolling hash sees; a cut is made where its high bits are zero.
WINDOW = 24
CUT_BITS = 11
#: Slots of the table of repeated chunks (16 MB in a task), whatever the size of the corpus.
TABLE_BITS = 1 << 24
#: Words whose tokens a worker keeps, and bytes of such words.
CACHED_WORDS = 1 << 20
CACHED_BYTES = 1 << 24
#: Bytes of text that a task encodes before it hands rows on.
SLICE = 1 << 22
SPACE = b" \t\n\r\x0b\x0c"


def tokenizer_file(name: str) -> str:
    """The vocabulary file of a public tokenizer; TOKENIZER_DIR names another folder."""
    own = os.environ.get("TOKENIZER_DIR")
    if own is None:
        own = os.path.dirname(importlib.util.find_spec("public_tokenizers").origin)
    return os.path.join(own, name)


class Codec:
    """A tokenizer of the tokenizers library, encoding word by word."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        self.kind = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.names = list(map(str, range(size)))
        self.cache: dict[bytes, bytes] = {}
        self.held = 0
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        self.lowers = '"Lowercase"' in json.dumps(made["normalizer"])
        # Letters and what follows them are then apart before any merge.
        rules = json.dumps(made["pre_tokenizer"])
        self.splits = all(json.dumps(part)[1:-1] in rules for part in (r"[\p{L}]+", r"[^\s\p{L}\p{N}]+"))
        probe = ["a", "b7", "c.", "É"]
        if self.raw(" ".join(probe)) != b"".join(map(self.raw, probe)) or self.raw(" \n"):
            raise ValueError("the tokenizer does not drop white space between words")

    def many(self, texts: list[str]) -> list[bytes]:
        coded = [c.ids for c in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        packed_ids = np.fromiter(chain.from_iterable(coded), dtype=self.kind).tobytes()
        ends = [0, *accumulate(len(c) * self.kind.itemsize for c in coded)]
        return [packed_ids[a:b] for a, b in zip(ends, ends[1:])]

    def raw(self, text: str) -> bytes:
        return self.many([text])[0]

    def decode(self, ids: bytes) -> str:
        return self.tokenizer.decode(np.frombuffer(ids, dtype=self.kind).tolist(), skip_special_tokens=False)

    def _stem(self, word: bytes) -> tuple[bytes, bytes]:
        """The word as letters in lower case and one mark at its end, where that gives the same tokens."""
        mark = word[-1:] if self.splits and word[-1:] in b".," else b""
        stem = word[: len(word) - len(mark)]
        if not stem.isalpha():
            return word, b""
        return stem.lower() if self.lowers else stem, mark

    def words(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each word; new ones are encoded in one call."""
        cache = self.cache
        found = list(map(cache.get, words))
        if None in found:
            missing = {w for w, ids in zip(words, found) if ids is None}
            if len(cache) > CACHED_WORDS or self.held > CACHED_BYTES:
                cache.clear()
                self.held, missing = 0, set(words)
            self.held += sum(map(len, missing))
            stems = {w: self._stem(w) for w in missing}
            new = list({x for pair in stems.values() for x in pair if x and x not in cache})
            cache.update(zip(new, self.many([w.decode() for w in new])))
            for w, (stem, mark) in stems.items():
                cache[w] = cache[stem] + cache[mark] if mark else cache[stem]
            found = [cache[w] for w in words]
        return found


class Derived(NamedTuple):
    """A column made from the packed ids of a row: its name, its type as Spark and Arrow write it, its value."""

    name: str
    type: str
    kind: pa.DataType
    of: Callable[[Codec, bytes], object]


@functools.lru_cache(maxsize=1)
def codec_of(path: str) -> Codec:
    """The worker's own codec, with the words it has seen in earlier tasks."""
    return Codec(path)


def cuts(data: bytes, rolling: Rolling) -> tuple[np.ndarray, np.ndarray]:
    """Places of the chunks' ends, and the chunks' hashes. A cut depends on the WINDOW bytes
    in front of it only, and never splits a character."""
    raw = np.frombuffer(data, dtype=np.uint8)
    sums = rolling.prefix(raw)
    ends = np.zeros(0, np.int64)
    if len(raw) > WINDOW:
        seen = (sums[WINDOW:-1] - sums[: -WINDOW - 1]) * rolling.down[: len(raw) - WINDOW]
        ends = np.flatnonzero(seen >> np.uint64(64 - CUT_BITS) == 0) + WINDOW
        ends = ends[(raw[ends] & 0xC0) != 0x80]
    ends = np.append(ends, len(raw))
    return ends, rolling.between(sums, np.concatenate(([0], ends[:-1])), ends)


def slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(TABLE_BITS)).astype(np.int64)


def repaired(codec: Codec, words: list[bytes], ids: list[bytes], at: int, seam: bytes) -> bytes | None:
    """Tokens of `seam`, which stands before words[at]. It is encoded with its neighbours, whose
    tokens must come out as `ids` has them; else the neighbourhood grows. None if it never agrees."""
    reach = 1
    while True:
        left, right = max(0, at - reach), min(len(words), at + reach)
        whole = codec.raw(b" ".join([*words[left:at], seam, *words[at:right]]).decode())
        before, after = b"".join(ids[left:at]), b"".join(ids[at:right])
        if whole.startswith(before) and whole.endswith(after) and len(whole) >= len(before) + len(after):
            return whole[len(before) : len(whole) - len(after)]
        if left == 0 and right == len(words):
            return None
        reach *= 2


def _digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def _texts(batch: pa.RecordBatch, column: str) -> Iterator[bytes]:
    for value in batch.column(column).cast(pa.binary()):
        yield value.as_py() or b""


def _count_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rolling = Rolling()
    for batch in batches:
        found = [cuts(t, rolling)[1] for t in _texts(batch, "text") if t]
        hashes, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], ["hash", "n"])


def _chunk_texts(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, bits = Rolling(), table.value
        for batch in batches:
            found: dict[bytes, bytes] = {}
            for t in _texts(batch, "text"):
                ends, hashes = cuts(t, rolling)
                for i in np.flatnonzero(bits[slots(hashes)]):
                    chunk = t[ends[i - 1] if i else 0 : ends[i]]
                    found.setdefault(_digest(chunk), chunk)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())], ["key", "chunk"]
            )

    return run


def _encode_chunks(path: str):
    """(key, chunk) to the packed ids and how many bytes of them the first and the last word have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path)
        for batch in batches:
            out = [codec.words(c.split()) for c in batch.column("chunk").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array([b"".join(w) for w in out], pa.binary()),
                    pa.array([len(w[0]) if w else 0 for w in out], pa.int32()),
                    pa.array([len(w[-1]) if w else 0 for w in out], pa.int32()),
                ],
                ["key", "ids", "first", "last"],
            )

    return run


def parts(codec: Codec, data: bytes, ends: np.ndarray, shared: np.ndarray) -> list[tuple]:
    """The text as (key, ids, cut_first, cut_last), in order. A shared chunk has a key and no ids;
    its first or last word is left out where a join takes it."""
    out: list[tuple] = []
    pending: list[bytes] = []
    start, carried = 0, b""

    def flush() -> None:
        if pending:
            out.append((None, b"".join(pending), False, False))
            pending.clear()

    words: list[bytes] = []
    coded: list[bytes] = []
    for i, end in enumerate(ends.tolist()):
        chunk = data[start:end]
        open_left = bool(i) and data[start - 1 : start] not in SPACE and chunk[:1] not in SPACE
        open_right = end < len(data) and data[end - 1 : end] not in SPACE and data[end : end + 1] not in SPACE
        start = end
        own = chunk.split()
        if open_right and open_left and len(own) == 1:
            carried += own[0]
            continue
        seam = None
        if open_left:
            seam, carried = carried + own[0], b""
        if open_right:
            carried = own[-1]
        core = own[int(open_left) : len(own) - int(open_right)]
        # Of a shared chunk only the words next to joins are encoded here.
        core_ids = codec.words(core[:8] + core[-8:] if shared[i] and len(core) > 16 else core)
        core = core[:8] + core[-8:] if len(core_ids) < len(core) else core
        if seam is not None:
            near = words + core
            made = repaired(codec, near, coded + core_ids, len(words), seam)
            if made is None:
                return [(None, codec.raw(data.decode()), False, False)]
            pending.append(made)
            words, coded = [seam], [made]
        if core:
            if shared[i]:
                flush()
                out.append((_digest(chunk), None, open_left, open_right))
            else:
                pending.append(b"".join(core_ids))
            words, coded = core[-8:], core_ids[-8:]
    flush()
    return out


def _encode_documents(path: str, table, reuse: bool, each: Derived | None = None):
    """`reuse`: documents with repeated chunks, as parts; else the others, as ids and what is derived from them."""
    part = pa.list_(pa.struct([
        ("pos", pa.int32()), ("key", pa.binary()), ("ids", pa.binary()), ("first", pa.bool_()), ("last", pa.bool_()),
    ]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, rolling, bits = codec_of(path), Rolling(), table.value
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            for a, b in blocks(sizes, SLICE):
                kept, out = [], []
                for row, t in enumerate(_texts(batch.slice(a, b - a), "text")):
                    ends, hashes = cuts(t, rolling)
                    shared = bits[slots(hashes)]
                    if bool(shared.any()) != reuse:
                        continue
                    kept.append(a + row)
                    made = parts(codec, t, ends, shared)
                    if reuse:
                        made = made or [(None, b"", False, False)]
                        out.append([{"pos": p, "key": k, "ids": x, "first": f, "last": e} for p, (k, x, f, e) in enumerate(made)])
                    else:
                        out.append(b"".join(x for _, x, _, _ in made))
                columns = [batch.column("_in").take(pa.array(kept, pa.int64())), pa.array(out, part if reuse else pa.binary())]
                names = ["_in", "_out"]
                if each:
                    columns.append(pa.array([each.of(codec, x) for x in out], each.kind))
                    names.append("_each")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _joined(path: str, each: Derived | None):
    """The parts of a row put together, and what is derived from them."""
    fields = [("ids", pa.binary()), *([("each", each.kind)] if each else [])]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = codec_of(path) if each else None
        for rows in batches:
            ids = (b"".join(p["ids"] for p in sorted(row.as_py(), key=lambda p: p["pos"])) for row in rows)
            yield pa.array([{"ids": x, "each": each.of(codec, x)} if each else {"ids": x} for x in ids], pa.struct(fields))

    return run


def repeated_chunks(rows: DataFrame) -> np.ndarray:
    """The table of slots of chunk hashes that occur twice or more."""
    counts = rows.select("text").mapInArrow(returned(_count_chunks), "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    return bit_table(counts.where("n >= 2"), "hash", TABLE_BITS)


def encode(docs: DataFrame, tokenizer: str, text: str = "text", carry: list[str] | None = None, each: Derived | None = None) -> DataFrame:
    """Adds `ids` (binary, packed), and the column `each` derives from them, to the columns `carry`, all of them unless named."""
    spark = docs.sparkSession
    carry = docs.columns if carry is None else carry
    rows = packed(docs, carry, text=F.col(text))
    table = spark.sparkContext.broadcast(repeated_chunks(rows))
    texts = rows.select("text").mapInArrow(returned(_chunk_texts(table)), "key binary, chunk binary")
    once = texts.groupBy("key").agg(F.first("chunk").alias("chunk"))
    shared = written(once.mapInArrow(returned(_encode_chunks(tokenizer)), "key binary, ids binary, first int, last int"), "chunks")

    kind = rows.schema["_in"].dataType.simpleString()
    made = f", _each {each.type}" if each else ""
    alone = rows.mapInArrow(returned(_encode_documents(tokenizer, table, False, each)), f"_in {kind}, _out binary{made}")
    part = "array<struct<pos:int,key:binary,ids:binary,first:boolean,last:boolean>>"
    split = rows.mapInArrow(returned(_encode_documents(tokenizer, table, True)), f"_in {kind}, _out {part}")
    split = split.withColumn("_row", F.monotonically_increasing_id())
    pieces = split.select("_row", "_in", F.explode("_out").alias("p")).select("_row", F.when(F.col("p.pos") == 0, F.col("_in")).alias("_in"), "p.*")
    known = shared.withColumnsRenamed({"ids": "all_ids", "first": "head", "last": "tail"})
    skip = F.when(F.col("first"), F.col("head")).otherwise(0)
    rest = F.length("all_ids") - skip - F.when(F.col("last"), F.col("tail")).otherwise(0)
    joined = pieces.join(known, "key", "left").select(
        "_row", "_in", "pos", F.coalesce("ids", F.substring("all_ids", skip + 1, rest)).alias("ids")
    )
    put = F.arrow_udf(_joined(tokenizer, each), f"struct<ids:binary{f',each:{each.type}' if each else ''}>")
    whole = joined.groupBy("_row").agg(
        F.first("_in", ignorenulls=True).alias("_in"), F.collect_list(F.struct("pos", "ids")).alias("parts")
    )
    whole = whole.select("_in", put("parts").alias("m"))
    both = alone.unionByName(whole.select("_in", F.col("m.ids").alias("_out"), *([F.col("m.each").alias("_each")] if each else [])))
    added = [F.col("_out").alias("ids"), *([F.col("_each").alias(each.name)] if each else [])]
    return unpacked(both, carry, *added)


def id_bytes(tokenizer: str) -> int:
    return Codec(tokenizer).kind.itemsize


def _decoder(path: str):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = codec_of(path)
        for ids in batches:
            yield pa.array([codec.decode(value or b"") for value in ids.to_pylist()], pa.string())

    return run


def decoded(ids: Column | str, tokenizer: str) -> Column:
    """The text of packed ids, special tokens included."""
    return F.arrow_udf(_decoder(tokenizer), "string")(ids)
