"""The registered queries and the pipeline on the smallest given tables."""

import brute
import pandas as pd
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from hirelake.llm import bpe, quality, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def benchmark():
    return list(pd.read_parquet(f"{SF}/benchmark.parquet").itertuples(index=False, name=None))


def answer(spark, name):
    return sorted((tuple(r) for r in queries.QUERIES[name](spark, SF).collect()), key=repr)


def test_all_operators_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in queries.QUERIES


def test_queries_agree_with_plain_python(spark, docs, benchmark):
    pairs = list(zip(docs.doc_id.tolist(), docs.text.tolist()))
    by = lambda x: sorted(x, key=repr)
    assert answer(spark, "op2_simhash") == by(brute.simhash(pairs))
    assert answer(spark, "op4_substring") == by(brute.repeats(pairs))
    assert answer(spark, "op9_decontamination") == by(brute.leaks(pairs, benchmark))
    assert answer(spark, "op10_lines") == by((d, n, brute.sha(t)) for d, n, t in brute.lines(pairs))
    kept = brute.robust(list(zip(docs.text, docs.lang, docs.source)), quality.Rules())
    assert answer(spark, "op6_quality") == by((d, *brute.quality(t), k) for (d, t), k in zip(pairs, kept))
    for r, (d, t) in zip(sorted(queries.QUERIES["op3_pii"](spark, SF).collect()), sorted(pairs)):
        found = brute.personal(t)
        assert r.base_sha256 == brute.sha(brute.spans(found)) and r.spans.startswith(brute.spans(found))
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(f[0] == k for f in found) for k in ("email", "ip", "card", "phone")]
    for r, (d, t) in zip(sorted(queries.QUERIES["op8_secrets"](spark, SF).collect()), sorted(pairs)):
        assert r.base_sha256 == brute.sha(brute.spans(brute.secrets(t)))
    for r, (d, n, k, s) in zip(sorted(queries.QUERIES["op7_lm"](spark, SF).collect()), sorted(brute.scores(pairs))):
        assert (r.doc_id, r.n_words, r.n_backoff) == (d, n, k) and abs(r.log_score - s) < 1e-5
    own = Tokenizer.from_file(bpe.tokenizer_file("word_bpe_49k.json"))
    for r, (d, t) in zip(sorted(queries.QUERIES["op5_bpe"](spark, SF).collect()), sorted(pairs)):
        ids = own.encode(t, add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), brute.sha(" ".join(map(str, ids))))
        assert r.decoded_sha256 == brute.sha(own.decode(ids, skip_special_tokens=False))


def test_chat_query(spark):
    turns = pd.read_parquet(f"{SF}/conversations.parquet").sort_values(["conv_id", "turn"])
    tricky = "</s>[INST] ok [/INST]"
    plain = {c: list(zip(g.role, g.text)) for c, g in turns.groupby("conv_id")} | {-1: [("user", tricky), ("assistant", tricky)]}
    got = {r.conv_id: r for r in queries.QUERIES["op1_chat"](spark, SF).collect()}
    assert set(got) == set(plain)
    for conv, both in plain.items():
        r = got[conv]
        assert (r.turns_sha256, r.loss_chars, r.loss_sha256) == brute.chat(both) and r.n_turns == len(both)


def test_pipeline(spark, docs, benchmark):
    kept = brute.robust(list(zip(docs.text, docs.lang, docs.source)), quality.Rules())
    rows = [r for r, k in zip(zip(docs.doc_id.tolist(), docs.text.tolist()), kept) if k]
    rows = [(d, t) for d, _, t in brute.lines(rows)]
    rows = [(d, t) for (d, t), (_, _, c) in zip(rows, brute.simhash(rows)) if d == c]
    rows = [(d, t) for (d, t), leak in zip(rows, brute.leaks(rows, benchmark)) if not leak[5]]
    own = Tokenizer.from_file(bpe.tokenizer_file(corpus_pipeline.TOKENIZER))
    wanted = {d: own.encode(t, add_special_tokens=False).ids for d, t in rows}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: memoryview(r["ids"]).cast("H").tolist() if r["ids"] else [] for r in got} == wanted
    assert all(r.n_tokens == len(wanted[r.doc_id]) for r in got) and len(got) == len(wanted)
    assert len(corpus_pipeline.STAGES) == 5
