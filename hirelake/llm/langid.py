"""Language identification by a convolutional network over bytes, trained here in numpy.

A text is cut into windows of `window` bytes (UTF-8, the last one filled up with zeros). Filters
of several widths slide over a window; each keeps its greatest value (max pooling), and a dense
layer with softmax turns these into one probability per language. A text's probabilities are
those of its windows, weighted by their bytes; every byte of the text counts.

A filter over one-hot bytes is a table with a row per byte value for each of its places, so a
convolution is a sum of looked-up rows: no matrix product over bytes, and windows are read in
blocks of bounded size however long the text is.

Training takes a bounded sample of labelled rows (`per_language` texts each, `most_texts` in all,
chosen by hash, so the same rows give the same network), from any place in the texts. Crops of
all lengths teach short texts. Only the network travels to the executors: its size depends on
the settings and the number of languages, not on the table.

Defined cases: a null text, or one without a letter, gives `und` and score 0, as does every text
when nothing is labelled; rows with a null label are not learned from; equal probabilities: the
first language by name; repeated rows each give their result; lone bytes that are no characters
cannot stand in a text. Very long texts take memory of one text. An empty table gives an empty
result. The added columns take the place of input columns of their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hirelake.llm.columns import packed, unpacked

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """`per_language` and `most_texts` bound the sample that is learned from; of each of its texts
    up to `crops` windows are taken."""

    per_language: int = 400
    most_texts: int = 20_000
    crops: int = 6
    window: int = 128
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    epochs: int = 12
    batch: int = 64
    rate: float = 0.01
    seed: int = 1


class Network:
    """`tables[j]` holds, per byte value, what a byte at place j of a filter adds to each filter.
    Filters are ordered from the widest to the narrowest, so those that have a place j come first."""

    def __init__(self, settings: Settings, languages: list[str]):
        pick = np.random.default_rng(settings.seed)
        self.settings, self.languages = settings, languages
        self.widths = sorted(settings.widths, reverse=True)
        n = settings.filters
        self.tables = [
            pick.normal(0, 0.3, (256, n * sum(w > j for w in self.widths))).astype(np.float32) for j in range(self.widths[0])
        ]
        self.bias = np.zeros(n * len(self.widths), np.float32)
        self.dense = pick.normal(0, 0.1, (n * len(self.widths), len(languages))).astype(np.float32)
        self.offset = np.zeros(len(languages), np.float32)

    def parts(self) -> list[np.ndarray]:
        return [*self.tables, self.bias, self.dense, self.offset]

    def convolved(self, windows: np.ndarray) -> np.ndarray:
        """(window, place, filter) for windows of bytes with widest - 1 zeros behind them."""
        size = windows.shape[1] - self.widths[0] + 1
        out = np.take(self.tables[0], windows[:, :size], axis=0)
        for j in range(1, len(self.tables)):
            table = self.tables[j]
            out[:, :, : table.shape[1]] += np.take(table, windows[:, j : j + size], axis=0)
        return out

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        pooled = np.maximum(self.convolved(windows).max(axis=1) + self.bias, 0)
        return softmax(pooled @ self.dense + self.offset)

    def cut(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The text's windows, with zeros behind each, and how many of its bytes each has."""
        size = self.settings.window
        count = -(-len(text) // size)
        padded = np.zeros(count * size, np.uint8)
        padded[: len(text)] = np.frombuffer(text, np.uint8)
        windows = np.zeros((count, size + self.widths[0] - 1), np.uint8)
        windows[:, :size] = padded.reshape(count, size)
        lengths = np.full(count, size)
        if count:
            lengths[-1] = len(text) - size * (count - 1)
        return windows, lengths

    def predict(self, texts: list[bytes], block: int = 64) -> np.ndarray:
        """(text, language) probabilities; texts without bytes have zeros."""
        out = np.zeros((len(texts), len(self.languages)))
        waiting, owners, weights = [], [], []

        def flush() -> None:
            windows = np.concatenate(waiting)
            scores = np.concatenate([self.probabilities(windows[i : i + block]) for i in range(0, len(windows), block)])
            np.add.at(out, np.concatenate(owners), scores * np.concatenate(weights)[:, None])
            for kept in (waiting, owners, weights):
                kept.clear()

        held = 0
        for i, text in enumerate(texts):
            windows, lengths = self.cut(text)
            if len(windows):
                waiting.append(windows)
                owners.append(np.full(len(windows), i))
                weights.append(lengths / len(text))
                held += len(windows)
            if held >= 16 * block:
                flush()
                held = 0
        if waiting:
            flush()
        return out


def softmax(values: np.ndarray) -> np.ndarray:
    values = np.exp(values - values.max(axis=1, keepdims=True))
    return values / values.sum(axis=1, keepdims=True)


def gradients(net: Network, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross entropy, for each of net.parts(). Only the place at which a filter has its
    greatest value passes anything back."""
    rows = np.arange(len(windows))
    values = net.convolved(windows)
    best = values.argmax(axis=1)
    before = np.take_along_axis(values, best[:, None, :], axis=1)[:, 0] + net.bias
    pooled = np.maximum(before, 0)
    error = softmax(pooled @ net.dense + net.offset)
    error[rows, labels] -= 1
    error /= len(windows)
    back = (error @ net.dense.T) * (before > 0)
    tables = []
    for j, table in enumerate(net.tables):
        n = table.shape[1]
        bytes_there = windows[rows[:, None], best[:, :n] + j]
        flat = np.bincount((bytes_there.astype(np.int64) * n + np.arange(n)).ravel(), back[:, :n].ravel(), table.size)
        tables.append(flat.reshape(table.shape).astype(np.float32))
    return [*tables, back.sum(axis=0), pooled.T @ error, error.sum(axis=0)]


def fit(texts: list[bytes], labels: list[str], settings: Settings) -> Network:
    """A network that has learned from the texts (Adam over mixed batches of crops)."""
    pick = np.random.default_rng(settings.seed + 1)
    net = Network(settings, sorted(set(labels)))
    size, tail = settings.window, net.widths[0] - 1
    number = {lang: i for i, lang in enumerate(net.languages)}
    crops, owners = [], []
    for text, label in zip(texts, labels):
        for i in range(min(settings.crops, 1 + len(text) // size)):
            length = size if i % 2 == 0 else int(pick.integers(8, size + 1))
            start = int(pick.integers(0, max(1, len(text) - length + 1)))
            crops.append(text[start : start + length].ljust(size + tail, b"\0"))
            owners.append(number[label])
    windows = np.frombuffer(b"".join(crops), np.uint8).reshape(len(crops), size + tail)
    targets = np.array(owners)
    # Each language weighs the same, however many crops it has.
    share = 1 / np.bincount(targets, minlength=len(net.languages))[targets]
    share /= share.sum()
    parts = net.parts()
    means, squares = ([np.zeros_like(p) for p in parts] for _ in range(2))
    steps = settings.epochs * -(-len(windows) // settings.batch)
    for step in range(1, steps + 1):
        chosen = pick.choice(len(windows), settings.batch, p=share)
        rate = settings.rate * (1 - (step - 1) / steps)
        for part, mean, square, slope in zip(parts, means, squares, gradients(net, windows[chosen], targets[chosen])):
            mean += 0.1 * (slope - mean)
            square += 0.001 * (slope * slope - square)
            part -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return net


def sampled(labelled: DataFrame, key: Column, text: Column, lang: Column, settings: Settings) -> DataFrame:
    """(lang, text) of at most per_language texts of each language and most_texts in all. Counts of
    the languages thin the rows by hash before any are ranked, so that no task sees a language
    whole; a language with fewer rows is taken whole."""
    rows = labelled.select(lang.alias("lang"), text.alias("text"), F.xxhash64(key, text).alias("h")).where(
        F.col("lang").isNotNull() & (F.length(F.coalesce("text", F.lit(""))) > 0)
    )
    # Whether a row may be chosen needs its hash alone: texts are shuffled for chosen ones only. The
    # first row of each language comes first, so no more than most_texts languages are ever chosen
    # from, and so many counts may go to every task.
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").limit(settings.most_texts)
    slots = F.lit(1 << 30)
    likely = F.pmod("h", slots) <= slots * (2 * settings.per_language / F.col("n"))
    best = W.partitionBy("lang").orderBy("h", "text")
    ranked = rows.join(F.broadcast(counts), "lang").where(likely).withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= settings.per_language).orderBy("rank", "lang").limit(settings.most_texts).select("lang", "text")


def trained(
    labelled: DataFrame, key: str | Column, text: str = "text", lang: str = "lang", settings: Settings | None = None
) -> Network | None:
    """A network fitted to a sample of the rows; None if no row has both a label and a text. The
    sample of at most settings.most_texts rows comes to the driver."""
    settings = settings or Settings()
    chosen = sampled(labelled, F.col(key) if isinstance(key, str) else key, F.col(text), F.col(lang), settings).collect()
    if not chosen:
        return None
    return fit([r["text"].encode() for r in chosen], [r["lang"] for r in chosen], settings)


def _predictor(net: Network | None):
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    def predict(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lettered in batches:
            plain = [t.encode() if ok and net else b"" for t, ok in zip(texts.to_pylist(), lettered.to_pylist())]
            scores = net.predict(plain) if net else np.zeros((len(plain), 1))
            best = scores.argmax(axis=1).tolist()
            top = np.minimum(scores.max(axis=1), 1.0).tolist()
            yield pa.array(
                [
                    {"lang_pred": net.languages[b] if net and t else UNKNOWN, "score": s if t else 0.0}
                    for t, b, s in zip(plain, best, top)
                ],
                kind,
            )

    return predict


def identify(docs: DataFrame, net: Network | None, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Adds lang_pred and score (the probability of that language) to the columns `carry`, all of
    them unless named. Nothing but the text is looked at."""
    carry = docs.columns if carry is None else carry
    udf = F.arrow_udf(_predictor(net), "struct<lang_pred:string,score:double>")
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    made = packed(docs, carry, _text=F.col(text), _letters=letters).select("_in", udf("_text", "_letters").alias("_p"))
    return unpacked(made.select("_in", "_p.*"), carry, "lang_pred", "score")
