"""Substring dedup: removes words of windows that also start in a document with a smaller id.

An FM-index per shard, and documents streamed through it by backward search, would make every
document meet every shard. So shards are made by content. Of each window of `window` words the
least hash of its runs of `GRAM` words is an anchor; equal windows have equal anchors at equal
places. All windows around an anchor lie in its segment: the run and the window - GRAM words on
either side. Windows can be equal only if their anchors are, so segments are dealt to shards by
their anchor, and the work grows with the text.

1. Anchors are counted by hash and segment digest (rolling hash and XXH3, 128 bits together). Anchors of one document
   are done with.
2. Equal segments fold to the least id that has one. Whatever other document has that segment
   loses all of it.
3. Where one anchor has different segments, one text per segment goes to the anchor's shard. There
   a segment is trimmed to what lies between its first and its last window whose hash another owner
   has as well; equal ones fold again. The shard builds an FM-index over what is left (wavelet matrix of
   the Burrows-Wheeler transform) and streams each through it; matching statistics of `window` and
   more against segments of smaller ids are the windows to remove.
4. An anchor with more than `crowd` different segments is too large for one shard. Its windows are
   halved by how many words they have before the anchor: those of a half have the words next to the
   anchor in common, by which they are dealt anew, and lie in a piece of the segment. Equal pieces fold, so a
   common passage is one text, whatever stands around it; groups that are still crowded are halved again.
   After at most log2(window) rounds a piece is one window, and those of a group are equal. A segment gives
   two rows a round, and only while its group is crowded: no round makes a row per window.
5. Ranges are collected per document and cut out.

Defined cases: null texts have no words; a document without id is never an earlier one and
loses nothing; rows of one id are the same document, so none of them is earlier than another;
repeated rows each give their result; an empty table gives an empty result. Added columns take
the place of input columns of their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.columns import bit_table, packed, unpacked
from hirelake.llm.fmindex import Index
from hirelake.llm.rolling import Rolling, blocks
from hirelake.llm.wordruns import Words
from hirelake.session import written

WINDOW = 50
GRAM = 16
#: Different segments of one anchor that one shard may have.
CROWD = 2000
#: Words in the index of a shard; whole anchors only.
SHARD_WORDS = 1 << 19
#: Characters of segments that a task gets, about.
SHARD_CHARS = 1 << 22
#: Slots of the table of anchors with different segments (16 MB in a task), whatever their number.
TABLE_BITS = 1 << 24


def tie(text: bytes) -> int:
    """A digest that tells rows of one id apart."""
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "big", signed=True)


def digests(data: bytes, starts: np.ndarray, ends: np.ndarray, leads: np.ndarray) -> np.ndarray:
    """64 bits of XXH3 of each stretch and of the anchor's place in it, which stand for its words:
    rolling hashes only propose, as they are equal for some pairs of long words."""
    places = zip(starts.tolist(), ends.tolist(), leads.tolist())
    return np.fromiter((xxhash.xxh3_64_intdigest(data[a:b], n) for a, b, n in places), np.uint64, len(starts))


class Segments:
    """Anchors of some texts: `text`, `hash`, `digest`, first word `low`, number of words `size`,
    and how many of them are before the anchor."""

    def __init__(self, texts: list[bytes], rolling: Rolling, window: int):
        self.words = w = Words(texts, rolling)
        places, self.hash = w.winnowed(window, GRAM)
        self.text = w.text[places]
        first, last = w.first[self.text], w.first[self.text + 1]
        self.begin = np.maximum(first, places - (window - GRAM))
        self.end = np.minimum(last, places + window)
        self.low, self.size = self.begin - first, self.end - self.begin
        self.lead = places - self.begin
        self.digest = digests(w.data, w.starts[self.begin], w.ends[self.end - 1], self.lead)

    def plain(self, i: int) -> str:
        return self.words.data[self.words.starts[self.begin[i]] : self.words.ends[self.end[i] - 1]].decode()


def _normal(batch: pa.RecordBatch) -> list[bytes]:
    return [b" ".join((t.as_py() or b"").split()) for t in batch.column("_text").cast(pa.binary())]


def _anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for batch in batches:
            texts = _normal(batch)
            for a, b in blocks([len(t) for t in texts]):
                s = Segments(texts[a:b], rolling, window)
                ties = np.array([tie(t) for t in texts[a:b]], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id").take(pa.array(s.text + a)), pa.array(ties[s.text]), pa.array(s.hash.view(np.int64)),
                        pa.array(s.digest.view(np.int64)), pa.array(s.low.astype(np.int32)), pa.array(s.size.astype(np.int32)),
                    ],
                    ["id", "tie", "hash", "digest", "low", "size"],
                )

    return run


def _segment_texts(window: int, table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, bits = Rolling(), table.value
        for batch in batches:
            texts = _normal(batch)
            for a, b in blocks([len(t) for t in texts]):
                s = Segments(texts[a:b], rolling, window)
                kept = np.flatnonzero(bits[(s.hash % np.uint64(TABLE_BITS)).astype(np.int64)])
                pairs = np.stack([s.hash[kept], s.digest[kept]], axis=1).view(np.int64)
                once = np.unique(pairs, axis=0, return_index=True)[1] if len(kept) else kept
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(pairs[once, 0]), pa.array(pairs[once, 1]), pa.array(s.lead[kept[once]].astype(np.int32)),
                        pa.array([s.plain(i) for i in kept[once]], pa.string()),
                    ],
                    ["hash", "digest", "lead", "plain"],
                )

    return run


def ranges(found: np.ndarray, window: int) -> list[dict]:
    """Words covered by the windows that start where `found` is true."""
    starts = np.flatnonzero(found)
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > window)
    first, last = np.concatenate(([0], breaks + 1)), np.append(breaks, len(starts) - 1)
    return [{"start": int(starts[a]), "end": int(starts[b]) + window} for a, b in zip(first, last)]


def shared_windows(pieces: list[np.ndarray], owners: np.ndarray, window: int, rolling: Rolling) -> tuple[np.ndarray, ...]:
    """Of each piece the first and the last window whose hash another owner has too (-1: none),
    and whether one of them has an earlier owner."""
    sizes = np.array([len(p) for p in pieces])
    flat, piece = np.concatenate(pieces), np.repeat(np.arange(len(pieces)), sizes)
    first, last, later = np.full(len(pieces), -1), np.full(len(pieces), -1), np.zeros(len(pieces), dtype=bool)
    at = np.arange(max(0, len(flat) - window + 1))
    at = at[piece[: len(at)] == piece[window - 1 :][: len(at)]]
    if not len(at):
        return first, last, later
    hashes = rolling.between(rolling.prefix(flat), at, at + window)
    order = np.argsort(hashes)
    own = owners[piece[at]]
    starts = np.flatnonzero(np.append(True, np.diff(hashes[order]) != 0))
    group = np.empty(len(at), dtype=np.int64)
    group[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(at))))
    least, most = np.minimum.reduceat(own[order], starts), np.maximum.reduceat(own[order], starts)
    kept = (least < most)[group]
    later[piece[at[kept & (least[group] < own)]]] = True
    at = at[kept]
    inside = at - (np.cumsum(sizes) - sizes)[piece[at]]
    last[piece[at]] = inside
    first[piece[at][::-1]] = inside[::-1]
    return first, last, later


def searched(pieces: list[np.ndarray], owners: np.ndarray, window: int, rolling: Rolling) -> list[list[dict]]:
    """The ranges of each piece that also stand in a piece of a smaller owner."""
    first, last, later = shared_windows(pieces, owners, window, rolling)
    folded: dict[bytes, int] = {}
    texts, least, asked, place = [], [], [], {}
    for i in np.flatnonzero(first >= 0).tolist():
        text = pieces[i][first[i] : last[i] + window]
        n = place[i] = folded.setdefault(text.tobytes(), len(texts))
        if n == len(texts):
            texts.append(text)
            least.append(owners[i])
            asked.append(later[i])
        elif owners[i] < least[n]:
            least[n], asked[n] = owners[i], later[i]
    out: list[list[dict]] = [[] for _ in pieces]
    if not texts:
        return out
    least, asked = np.array(least), np.flatnonzero(asked)
    found = Index(texts, least).matches([texts[n] for n in asked], least[asked], window)
    spans = {int(n): ranges(f >= window, window) for n, f in zip(asked, found)}
    for i, n in place.items():
        at = int(first[i])
        if owners[i] > least[n]:
            out[i] = [{"start": at, "end": at + len(texts[n])}]
        else:
            out[i] = [{"start": at + r["start"], "end": at + r["end"]} for r in spans.get(n, ())]
    return out


def _search(window: int):
    """Segments sorted by anchor to the ranges of each; complete anchors fill a shard."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def shard(rows: list[dict], rolling: Rolling) -> pa.RecordBatch:
        numbers: dict[str, int] = {}
        pieces = [np.array([numbers.setdefault(w, len(numbers)) for w in r["plain"].split(" ")]) for r in rows]
        owners = np.unique([r["owner"] for r in rows], return_inverse=True)[1]
        out = searched(pieces, owners, window, rolling)
        kept = [i for i, x in enumerate(out) if x]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([rows[i]["hash"] for i in kept], pa.int64()), pa.array([rows[i]["digest"] for i in kept], pa.int64()),
                pa.array([out[i] for i in kept], kind),
            ],
            ["hash", "digest", "found"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, held, total = Rolling(), [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if total > SHARD_WORDS and row["hash"] != held[-1]["hash"]:
                    yield shard(held, rolling)
                    held, total = [], 0
                held.append(row)
                total += row["plain"].count(" ") + 2
        if held:
            yield shard(held, rolling)

    return run


def _halved(window: int):
    """Each piece twice: around its windows with few and with many of their words before the anchor. `part`
    stands for the words that all windows of a half share; a text comes once per batch."""
    reach = window - GRAM
    names = ["part", "piece", "at", "size", "lead", "low", "high", "plain"]
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 5, pa.string()]

    def digest(text: str, seed: int = 0) -> int:
        return int.from_bytes(xxhash.xxh3_64_digest(text.encode(), seed), "big", signed=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, out, seen = [], [], set()
            for i, r in enumerate(batch.select(["hash", "lead", "low", "high", "plain"]).to_pylist()):
                words, lead = r["plain"].split(" "), r["lead"]
                behind, middle = len(words) - lead - GRAM, (r["low"] + r["high"] + 1) // 2
                for low, high in ((r["low"], middle - 1), (middle, r["high"])):
                    if max(low, reach - behind) > min(high, lead):
                        continue
                    common = " ".join(words[lead - low : lead + GRAM + reach - high])
                    begin, end = max(0, lead - high), min(len(words), lead + GRAM + reach - low)
                    plain = " ".join(words[begin:end])
                    part, piece = digest(f"{r['hash']} {low} {high} {common}"), digest(plain, lead - begin)
                    own.append(i)
                    out.append((part, piece, begin, end - begin, lead - begin, low, high, None if (part, piece) in seen else plain))
                    seen.add((part, piece))
            row = pa.array(own, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(row) for c in ("hash", "digest", "owner")),
                    *(pa.array([x[c] for x in out], kind) for c, kind in enumerate(kinds)),
                ],
                ["hash", "digest", "owner", *names],
            )

    return run


def _spread(crowded: DataFrame, window: int, crowd: int) -> tuple[DataFrame, list[DataFrame]]:
    """Pieces of crowded anchors in groups of at most `crowd`, and for each round which pieces its rows
    became, with the pieces' least owner."""
    id_kind = crowded.schema["owner"].dataType.simpleString()
    schema = f"hash long, digest long, owner {id_kind}, part long, piece long, at int, size int, lead int, low int, high int, plain string"
    columns, few, rounds = ["hash", "digest", "owner", "lead", "low", "high", "plain"], [], []
    crowded = crowded.withColumns({"low": F.lit(0), "high": F.lit(window - GRAM)}).select(columns)
    while not crowded.isEmpty():
        halves = written(crowded.mapInArrow(_halved(window), schema), "halves")
        pieces = halves.groupBy("part", "piece").agg(
            F.min("owner").alias("owner"), *(F.first(c).alias(c) for c in ("lead", "low", "high")), F.first("plain", ignorenulls=True).alias("plain")
        )
        pieces = written(pieces.withColumnsRenamed({"part": "hash", "piece": "digest"}), "folded-halves")
        groups = pieces.groupBy("hash").agg(F.count("*").alias("segments"), F.min("owner").alias("least"), F.max("owner").alias("most"))
        mixed = pieces.join(groups.where("segments > 1 and least < most").select("hash", "segments"), "hash")
        least = pieces.select(F.col("hash").alias("part"), F.col("digest").alias("piece"), F.col("owner").alias("earlier"))
        rounds.append(halves.drop("plain").join(least, ["part", "piece"]))
        few.append(mixed.where(F.col("segments") <= crowd).select("hash", "digest", "owner", "plain"))
        crowded = written(mixed.where(F.col("segments") > crowd).select(columns), "crowded")
    out = crowded.select("hash", "digest", "owner", "plain")
    for pieces in few:
        out = out.unionByName(pieces)
    return written(out, "pieces"), rounds


def _gone(rows: DataFrame, window: int, crowd: int) -> DataFrame:
    """(id, tie, start, end): ranges of words to remove."""
    id_kind = rows.schema["_id"].dataType.simpleString()
    rows = rows.where("_id is not null").select("_id", "_text")
    anchors = written(
        rows.mapInArrow(_anchors(window), f"id {id_kind}, tie long, hash long, digest long, low int, size int"), "anchors"
    )
    folded = anchors.groupBy("hash", "digest").agg(F.min("id").alias("owner"), F.max("id").alias("last"))
    folded = written(folded, "segments")
    shared = folded.groupBy("hash").agg(
        F.min("owner").alias("owner"), F.max("last").alias("last"), F.count("*").alias("segments")
    ).where("owner < last")
    shared = shared.select("hash", "segments", F.col("owner").alias("least"))
    known = written(folded.join(shared, "hash").select("hash", "digest", "owner", "least", "segments"), "shared-segments")
    mixed = known.where("segments > 1")

    table = rows.sparkSession.sparkContext.broadcast(bit_table(mixed, "hash", TABLE_BITS))
    texts = rows.mapInArrow(_segment_texts(window, table), "hash long, digest long, lead int, plain string")
    texts = texts.groupBy("hash", "digest").agg(F.first("lead").alias("lead"), F.first("plain").alias("plain"))
    texts = written(texts.join(mixed, ["hash", "digest"]), "segment-texts")
    dealt = texts.where(F.col("segments") <= crowd).select("hash", "digest", "owner", "plain")

    few, rounds = _spread(texts.where(F.col("segments") > crowd), window, crowd)

    # Searching takes much longer than moving, so there are as many tasks as shards, small as they are.
    total = dealt.agg(F.coalesce(F.sum(F.length("plain")), F.lit(0))).first()[0]
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(total) // SHARD_CHARS)
    dealt = dealt.unionByName(few).repartition(tasks, "hash").sortWithinPartitions("hash")
    span = "array<struct<start:int,end:int>>"
    found = dealt.mapInArrow(_search(window), f"hash long, digest long, found {span}")
    found = found.select("hash", "digest", F.explode("found").alias("r")).select("hash", "digest", "r.*")
    own = written(found, "found")
    # What was found in a piece holds for the segments of its owner; the others lose all of it.
    for pieces in reversed(rounds):
        later = pieces.where("earlier < owner").select("hash", "digest", F.col("at").alias("start"), (F.col("at") + F.col("size")).alias("end"))
        same = pieces.where("earlier = owner").join(own.withColumnsRenamed({"hash": "part", "digest": "piece"}), ["part", "piece"]).select(
            "hash", "digest", (F.col("at") + F.col("start")).alias("start"), (F.col("at") + F.col("end")).alias("end")
        )
        own = written(own.unionByName(later).unionByName(same), "found")
    placed = anchors.join(known, ["hash", "digest"])
    placed = written(placed.select("id", "tie", "hash", "digest", "low", "size", "owner"), "placed")
    whole = placed.where((F.col("owner") < F.col("id")) & (F.col("size") >= window)).select(
        "id", "tie", F.col("low").alias("start"), (F.col("low") + F.col("size")).alias("end")
    )
    some = placed.where("owner = id").join(own, ["hash", "digest"]).select(
        "id", "tie", (F.col("low") + F.col("start")).alias("start"), (F.col("low") + F.col("end")).alias("end")
    )
    return whole.unionByName(some)


def _cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
    for texts, gone in batches:
        out = []
        for text, spans in zip(texts.cast(pa.binary()), gone.to_pylist()):
            words = (text.as_py() or b"").split()
            keep = np.ones(len(words), dtype=bool)
            for s in spans or ():
                keep[s["start"] : s["end"]] = False
            kept = words if keep.all() else [words[i] for i in np.flatnonzero(keep)]
            out.append({"n_words": len(words), "n_removed": len(words) - len(kept), "kept": b" ".join(kept).decode()})
        yield pa.array(out, kind)


def _ties(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.array([tie(b" ".join((t.as_py() or b"").split())) for t in texts.cast(pa.binary())], pa.int64())


def dedupe(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", carry: list[str] | None = None,
           window: int = WINDOW, crowd: int = CROWD) -> DataFrame:
    """Adds `n_words`, `n_removed` and `kept_text` (kept words, one space between them) to the
    columns `carry`, all of them unless named."""
    if window <= GRAM:
        raise ValueError(f"a window has more than {GRAM} words")
    carry = docs.columns if carry is None else carry
    rows = packed(docs, carry, _text=F.col(text), _id=F.col(doc_id))
    spans = _gone(rows, window, crowd).groupBy("id", "tie").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    spans = written(spans.withColumnsRenamed({"id": "_gone_id", "tie": "_gone_tie"}), "removed-words")
    joined = rows.withColumn("_tie", F.arrow_udf(_ties, "long")("_text")).join(
        spans, (F.col("_tie") == F.col("_gone_tie")) & (F.col("_id") == F.col("_gone_id")), "left"
    )
    made = F.arrow_udf(_cut, "struct<n_words:long,n_removed:long,kept:string>")("_text", "spans")
    return unpacked(joined.select("_in", made.alias("m")), carry, *(F.col(f"m.{a}").alias(b) for a, b in (("n_words", "n_words"), ("n_removed", "n_removed"), ("kept", "kept_text"))))
