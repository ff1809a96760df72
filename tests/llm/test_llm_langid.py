"""Language identification: the arithmetic, and accuracy on documents it has not seen."""

import numpy as np
from cases import CLASHES, documents

from hirelake.llm import langid, queries

TINY = langid.Settings(per_language=50, epochs=6, crops=3, filters=8)


def test_convolution_and_pooling():
    net = langid.Network(langid.Settings(widths=(2, 3), filters=2, window=7), ["a", "b"])
    text = b"some bytes \xc3\xa9 of tex"
    windows, lengths = net.cut(text)
    assert lengths.tolist() == [7, 7, 6] and b"".join(bytes(w[:7]) for w in windows).rstrip(b"\0") == text
    out = np.zeros(2)
    for window, length in zip(windows, lengths):
        pooled = []
        for f in range(4):  # filters 0 and 1 are three bytes wide, 2 and 3 two
            width = 3 if f < 2 else 2
            sums = [sum(net.tables[j][window[i + j], f] for j in range(width)) for i in range(7)]
            pooled.append(max(max(sums) + net.bias[f], 0))
        scores = np.exp(np.array(pooled) @ net.dense + net.offset)
        out += scores / scores.sum() * length / len(text)
    assert np.allclose(net.predict([text]), [out], atol=1e-5)


def test_gradients_are_those_of_the_loss():
    net = langid.Network(langid.Settings(widths=(2, 3), filters=3, window=9), ["a", "b", "c"])
    pick = np.random.default_rng(4)
    windows, labels = pick.integers(0, 5, (6, 11)).astype(np.uint8), pick.integers(0, 3, 6)
    for part in (net.tables, [net.bias, net.dense, net.offset]):
        for array in part:
            array[:] = pick.normal(0, 0.5, array.shape)
    loss = lambda: -np.log(net.probabilities(windows)[np.arange(6), labels]).mean()
    for part, slope in zip(net.parts(), langid.gradients(net, windows, labels)):
        for place in zip(*(axis[:12] for axis in np.nonzero(slope))):
            kept = part[place]
            part[place] = kept + 1e-2
            more = loss()
            part[place] = kept - 1e-2
            less = loss()
            part[place] = kept
            assert abs((more - less) / 2e-2 - slope[place]) < 5e-3


def test_blocks_do_not_change_the_result():
    net = langid.Network(langid.Settings(), ["a", "b"])
    text = bytes(range(256)) * 300
    assert np.allclose(net.predict([text, b"", b"x"], block=7), net.predict([text, b"", b"x"], block=1000), atol=1e-6)


def test_held_out_accuracy(spark):
    rows = queries.op12_language(spark, "/root/testdata/sf0.01").alias("p")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null").alias("d")
    held = rows.join(docs, "doc_id").where("held_out").selectExpr("lang_pred = lang as right", "score").collect()
    assert len(held) > 100 and all(0 <= r["score"] <= 1 for r in held)
    assert sum(r["right"] for r in held) / len(held) > 0.95


def test_query_looks_at_text_alone(spark, tmp_path):
    """Other labels, sources and ids of held-out rows change nothing; nor do their texts change others."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = "crc32(cast(cast(doc_id as string) as binary)) % 4 = 2"
    changed = docs.selectExpr(
        "doc_id", f"case when {held} then concat('le la ', text) else text end as text",
        f"case when {held} then 'zz' else lang end as lang", "'other' as source", "n_chars",
    )
    changed.write.parquet(str(tmp_path / "documents.parquet"))
    key = lambda df: {r[0]: tuple(r)[1:] for r in df.where("not held_out").collect()}
    assert key(queries.op12_language(spark, str(tmp_path))) == key(queries.op12_language(spark, "/root/testdata/sf0.001"))


def test_awkward_rows(spark):
    net = langid.fit([b"the cat and the dog " * 20, "der Hund ist schön ".encode() * 20] * 20, ["en", "de"] * 20, TINY)
    odd = [(1, None), (2, ""), (3, "12 34 .,"), (4, "x"), (None, "der Hund " * 9), (None, "der Hund " * 9), (5, "the dog and " * 50_000)]
    got = langid.identify(documents(spark, odd, (*CLASHES, "Score", "_p", "_letters")), net)
    assert [c for c in got.columns if c.lower() == "score"] == ["score"] and "_letters" in got.columns
    by = sorted((r["doc_id"] or 0, r["lang_pred"], r["score"] > 0) for r in got.collect())
    assert by[:2] == [(0, "de", True)] * 2 and by[2:5] == [(i, "und", False) for i in (1, 2, 3)]
    assert by[5][1] in ("en", "de") and by[6] == (5, "en", True)


def test_nothing_to_learn_from(spark):
    none = documents(spark, [])
    assert langid.trained(none, "doc_id") is None and langid.identify(none, None).collect() == []
    unlabelled = documents(spark, [(1, "some text")]).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert langid.trained(unlabelled, "doc_id") is None
    assert [r["lang_pred"] for r in langid.identify(documents(spark, [(1, "some text")]), None).collect()] == ["und"]


def test_sample_is_bounded_and_the_same(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    few = langid.Settings(per_language=10, most_texts=25)
    take = lambda df: [tuple(r) for r in langid.sampled(df, df.doc_id, df.text, df.lang, few).collect()]
    one, other = take(docs), take(docs.repartition(7))
    assert len(one) == 25 and sorted(one) == sorted(other)
    assert len({lang for lang, _ in one}) == docs.select("lang").where("lang is not null").distinct().count()
