"""Language-model scores by stupid backoff, with counts exchanged per block of texts.

    S(b | a) = c(a b) / c(a)            where the pair occurs elsewhere
             = alpha * c(b) / N         else, where the word does
             = alpha * alpha / N        else

All counts are those of the other documents: a document's own occurrences are taken off, so
no text vouches for itself. The first word of a document has no context and scores c(b) / N.
The result grows with nothing but the texts: no table is broadcast or collected.

1. Texts become blocks of about `crowd` words, in which words are numbers.
2. A block sends its different words and pairs, once each with how often they occur, to BUCKETS parts by
   their digest: one row per block and part. However frequent a word or pair, it comes once per block.
3. A part adds up and returns the sums in the order in which the words and pairs came, without the digests.
4. A block takes each document's own occurrences off and adds up the logarithms of each document.

Words are told apart by 64 bits of a keyed hash and pairs by 64 bits mixed from those of their words: among
a thousand million different ones a clash, which would add up two counts, has a chance of three in a hundred.

Defined cases: a null text, like any without words, has no tokens and a null score; repeated
rows are documents of their own, so copies vouch for each other; in a corpus of one document
nothing is known and the score is null; an empty table gives an empty result. Added columns
take the place of input columns of their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.llm.columns import packed, unpacked
from hirelake.llm.rolling import FACTOR, blocks, mixed
from hirelake.session import written

ALPHA = 0.4
#: Words of a block, about; one text is never cut.
CROWD = 1 << 20
#: Parts by digest (a power of two), whatever the size of the corpus.
BUCKETS = 1 << 12
#: Digests of a part.
STRETCH = np.uint64((1 << 64) // BUCKETS)


def digests(words: np.ndarray) -> np.ndarray:
    """64 bits of a keyed hash of each word, which stand for the word: polynomial hashes are equal
    for some pairs of long words."""
    return pd.util.hash_array(words, categorize=False) if len(words) else np.zeros(0, np.uint64)


def narrow(values: np.ndarray, ends: list[int]) -> pa.Array:
    """Stretches of whole numbers (uint64), each in as few bytes a number as its largest needs."""
    raw, out = values.astype("<u8").view(np.uint8).reshape(-1, 8), []
    for a, b in zip([0, *ends], ends):
        width = max(1, (int(values[a:b].max()).bit_length() + 7) // 8)
        out.append(raw[a:b, :width].tobytes())
    return pa.array(out, pa.binary())


def widened(data: bytes, n: int) -> np.ndarray:
    """The `n` numbers of one stretch again."""
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, : len(data) // n] = np.frombuffer(data, np.uint8).reshape(n, -1)
    return out.view("<u8").ravel()


def _lists(values: np.ndarray, ends: list[int]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(values))


def _pressed(numbers: np.ndarray) -> bytes:
    """Compressed, byte by byte of all numbers."""
    return pa.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)


def _unpressed(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, "zstd", asbytes=True), np.uint8).reshape(4, n)
    return planes.T.copy().view("<u4").ravel()


def _blocks(crowd: int):
    """Rows to blocks: their carried columns, words per row, each word's number, and the digests by number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = [b" ".join((t.as_py() or b"").lower().split()) for t in batch.column("text").cast(pa.binary())]
            for a, b in blocks(sizes := [t.count(b" ") + 1 if t else 0 for t in texts], crowd):
                data = b" ".join(t for t in texts[a:b] if t)
                code, found = pd.factorize(np.array(data.split(b" ") if data else [], dtype=object))
                known, number = np.unique(digests(found), return_inverse=True)
                # Small numbers for frequent words, so that they take little room.
                often = np.argsort(-np.bincount(number[code], minlength=len(known)))
                known, number = known[often], np.argsort(often)[number]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), batch.column("_in").slice(a, b - a)),
                        _lists(np.array(sizes[a:b], dtype=np.int32), [b - a]), pa.array([_pressed(number[code])], pa.binary()),
                        _lists(known.view(np.int64), [len(known)]),
                    ],
                    ["block", "rows", "sizes", "words", "known"],
                )
                block += 1

    return run


class Grams:
    """The words and different pairs of a block. `digest` and `count` have the words first, then the pairs; `order`
    sorts them by digest. `text` is the text of each word, `inside` the places of words that have a next one in their
    text, `pair` which pair is there."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray, known: np.ndarray):
        self.text = np.repeat(np.arange(len(sizes)), sizes)
        self.inside = np.flatnonzero(self.text[:-1] == self.text[1:])
        wide = words.astype(np.int64)
        pairs, self.pair, counts = np.unique(wide[self.inside] << 32 | wide[self.inside + 1], return_inverse=True, return_counts=True)
        known = known.view(np.uint64)
        joined = mixed(mixed(known[pairs >> 32] + np.uint64(FACTOR)) + known[pairs & 0xFFFFFFFF])
        self.digest = np.concatenate((known, joined))
        self.count = np.concatenate((np.bincount(words, minlength=len(known)), counts))
        self.order = np.argsort(self.digest)


def _block(table: pa.Table | pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, number of each word, and digests by number."""
    sizes, known = (table.column(c)[row].values.to_numpy(zero_copy_only=False) for c in ("sizes", "known"))
    return sizes, _unpressed(table.column("words")[row].as_py(), int(sizes.sum())), known


def _sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's words and pairs by part."""
    for batch in batches:
        for i in range(batch.num_rows):
            grams = Grams(*_block(batch, i))
            digest = grams.digest[grams.order]
            part = (digest // STRETCH).astype(np.int32)
            ends = np.flatnonzero(np.diff(part, append=-1)) + 1
            # In a part what a digest is more than the one before it, and the first more than the part's least.
            more = np.diff(digest, prepend=np.uint64(0))
            first = np.append(0, ends[:-1])[: len(ends)]
            more[first] = digest[first] % STRETCH
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[ends - 1]), pa.array(np.full(len(ends), batch.column("block")[i].as_py())), pa.array(np.diff(ends, prepend=0)),
                    narrow(more, ends.tolist()), narrow(grams.count[grams.order].astype(np.uint64), ends.tolist()),
                ],
                ["part", "block", "size", "digests", "counts"],
            )


def _summed(table: pa.Table) -> pa.Table:
    """Sums over all blocks of a part, for each block in its order."""
    sizes = table.column("size").to_pylist()
    digests, counts = (list(map(widened, table.column(c).to_pylist(), sizes)) for c in ("digests", "counts"))
    at = np.unique(np.concatenate([np.cumsum(x) for x in digests]), return_inverse=True)[1]
    sums = np.zeros(at.max() + 1, dtype=np.uint64)
    np.add.at(sums, at, np.concatenate(counts))
    return table.select(["block", "part", "size"]).append_column("sums", narrow(sums[at], np.cumsum(sizes).tolist()))


def _scored(total: int, alpha: float):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        sizes, words, known = _block(left, 0)
        grams = Grams(sizes, words, known)
        sums = np.zeros(len(grams.digest), dtype=np.int64)
        right = right.sort_by("part")
        if right.num_rows:
            sums[grams.order] = np.concatenate(list(map(widened, right.column("sums").to_pylist(), right.column("size").to_pylist())))
        text, inside, n_words = grams.text, grams.inside, sizes.astype(np.int64)
        _, at, own = np.unique(text.astype(np.int64) << 32 | words, return_inverse=True, return_counts=True)
        elsewhere = sums[words] - own[at]
        _, one, n = np.unique(text[inside].astype(np.int64) << 32 | grams.pair, return_index=True, return_counts=True)
        both = sums[len(known) + grams.pair[one]] - n
        seen, a = both > 0, math.log(alpha)
        # Words elsewhere as backoff, and pairs elsewhere by what they have before them.
        alone = np.where(elsewhere > 0, np.log(np.maximum(elsewhere, 1)), a)
        after = np.where(
            seen, np.log(np.maximum(both, 1)) - np.log(np.maximum(elsewhere[inside[one]], 1)), a + alone[inside[one] + 1]
        )
        first = np.flatnonzero(np.diff(text, prepend=-1))
        of = np.concatenate((text[inside[one]], text[first]))
        s = np.bincount(of, np.concatenate((n * after, alone[first])), len(sizes))
        k = np.bincount(of, np.concatenate((np.where(seen, 0, n), np.ones(len(first)))), len(sizes)).astype(np.int64)
        others = total - n_words
        has = (others > 0) & (n_words > 0)
        per_word = (s - k * np.log(np.maximum(others, 1))) / np.maximum(n_words, 1)
        return pa.table({"_in": left.column("rows").combine_chunks().flatten(), "n_words": n_words, "n_backoff": k, "log_score": pa.array(per_word, mask=~has)})

    return run


def score(docs: DataFrame, text: str = "text", carry: list[str] | None = None, alpha: float = ALPHA, crowd: int = CROWD) -> DataFrame:
    """Adds `n_words`, `n_backoff` (words scored without context) and `log_score` (natural
    logarithm per word, double) to the columns `carry`, all of them unless named."""
    carry = docs.columns if carry is None else carry
    rows = packed(docs, carry, text=F.col(text))
    kind = rows.schema["_in"].dataType
    ints, longs = T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())
    schema = T.StructType().add("block", "long").add("rows", T.ArrayType(kind)).add("sizes", ints).add("words", "binary").add("known", longs)
    made = written(rows.mapInArrow(_blocks(crowd), schema), "blocks")
    total = made.agg(F.coalesce(F.sum(F.expr("aggregate(sizes, 0L, (a, n) -> a + n)")), F.lit(0))).first()[0]
    sent = made.select("block", "sizes", "words", "known").mapInArrow(_sent, "part int, block long, size long, digests binary, counts binary")
    sums = sent.groupBy("part").applyInArrow(_summed, "block long, part int, size long, sums binary")
    scored = T.StructType().add("_in", kind).add("n_words", "long").add("n_backoff", "long").add("log_score", "double")
    out = made.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(_scored(total, alpha), scored)
    return unpacked(out, carry, "n_words", "n_backoff", "log_score")
