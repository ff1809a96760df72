"""Every operator against plain Python on small tables with awkward cases."""

import base64
import json
import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from cases import CLASHES, documents, texts
from pyspark.sql import functions as F

from hirelake.llm import bpe, chat, decontam, lines, lm, pii, quality, secrets, simhash, substring
from hirelake.llm.components import components
from hirelake.llm.fmindex import Index
from hirelake.session import tables_made

BYTES, WORDS = (bpe.tokenizer_file(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
RULES = quality.Rules(pull=5)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def items(spark, text=True):
    whole = texts()
    made = [
        (1, " ".join(whole[3][1].split()[:30])), (2, " ".join(whole[8][1].split()[5:18])), (2, "one two three"),
        (None, " ".join(whole[11][1].split()[:12])), (3, None), (4, ""), (5, "x"), (6, "no such words here at all in any of the texts"),
        (7, "a " * 20), (8, " ".join(whole[3][1].split()[:30])),
    ]
    return made, spark.createDataFrame(made, "item_id long, text string")


OPERATORS = {
    "chat": lambda s, d: chat.format_conversations(d.selectExpr("doc_id conv_id", "n_chars turn", "lang role", "text"), BYTES),
    "simhash": lambda s, d: simhash.cluster(d),
    "pii": lambda s, d: pii.find(d),
    "substring": lambda s, d: substring.dedupe(d),
    "bpe": lambda s, d: bpe.encode(d, WORDS),
    "quality": lambda s, d: quality.score(d, rules=RULES),
    "lm": lambda s, d: lm.score(d),
    "secrets": lambda s, d: secrets.find(d),
    "decontam": lambda s, d: decontam.check(d, items(s)[1]),
    "lines": lambda s, d: lines.dedupe(d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, documents(spark, [])).collect() == []


@pytest.mark.parametrize("name", sorted(set(OPERATORS) - {"chat"}))
def test_clashing_names_and_repeated_rows(spark, name):
    made = texts()[:12] + texts()[-9:-1]
    plain, clash = documents(spark, made + made), documents(spark, made + made, CLASHES)
    expected, got = OPERATORS[name](spark, plain), OPERATORS[name](spark, clash)
    assert got.count() == expected.count() == 2 * len(made)
    added = [c for c in expected.columns if c not in plain.columns]
    assert added == [c for c in got.columns if c in added]
    both = [c for c in expected.columns if c != "keeper"]
    assert rows(got, *both) == rows(expected, *both)
    rest = [c for c in CLASHES if c not in added]
    assert set(rest) <= set(got.columns)
    assert got.select(rest[0]).distinct().collect() == [(f"own {rest[0]}",)]


def test_empty_benchmark(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r[0] for r in decontam.check(documents(spark), none).select("contaminated").collect())


def test_quality_statistics(spark):
    got = rows(quality.score(documents(spark), rules=RULES), "doc_id", *quality.STATS[:5], "base_failed")
    assert got == sorted(((d, *brute.quality(t)) for d, t in texts()), key=repr)


def test_quality_fit(spark):
    pick = random.Random(3)
    made = []
    for i in range(150):
        words = ["".join(pick.choice("abcdefgh") for _ in range(pick.randint(3, 8))) for _ in range(90)]
        if i % 15 == 0:
            words = [w + pick.choice("#$%") * 2 for w in words]
        made.append((i, " ".join(words)))
    docs = documents(spark, made)
    scored = quality.score(docs, rules=RULES).orderBy("doc_id").collect()
    plain = [(r.text, r.lang, r.source) for r in docs.orderBy("doc_id").collect()]
    assert [r.kept for r in scored] == brute.robust(plain, RULES)
    assert [r.doc_id for r in scored if not r.kept] == [i for i in range(150) if i % 15 == 0]
    assert quality.kept(docs, rules=RULES).columns == docs.columns


def test_quality_makes_the_rows_of_the_fit_once(spark):
    with tables_made() as paths:
        passed = quality.score(documents(spark), rules=RULES).where("not base_failed").count()
    vectors = spark.read.parquet(next(p for p in paths if "/vectors-" in p))
    assert passed and vectors.count() == 3 * passed and vectors.where("_group = '0'").count() == passed


def test_quality_small_pairs(spark):
    """A pair of 40 documents is judged by its own statistics, one of three mostly by its language's."""
    pick = random.Random(8)
    word = lambda a, b: "".join(pick.choice("abcdefgh") for _ in range(pick.randint(a, b)))
    made = [(" ".join(word(3, 8) for _ in range(90)), "en", "large") for _ in range(300)]
    made += [(" ".join(word(9, 14) for _ in range(90)), "en", "long words") for _ in range(40)]
    made += [(" ".join(word(3, 8) for _ in range(90)), "en", "tiny") for _ in range(2)]
    made += [(" ".join(word(3, 8) + "#$%" for _ in range(90)), "en", "tiny"), (" ".join(word(3, 8) for _ in range(90)), None, None)]
    schema = "doc_id long, text string, lang string, source string"
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(made)], schema)
    scored = quality.score(docs).orderBy("doc_id").collect()
    assert [r.kept for r in scored] == brute.robust(made, quality.Rules())
    assert all(r.kept for r in scored[300:342]) and not scored[342].kept and scored[343].kept
    assert sum(r.kept for r in scored[:300]) > 290
    one = quality.score(docs.where("doc_id = 343")).collect()
    assert [(r.kept, r.distance is not None) for r in one] == [(True, True)]


def test_simhash(spark):
    got = simhash.cluster(documents(spark))
    named = [(d, f"{f & (1 << 64) - 1:016x}", c) for d, f, c in rows(got, "doc_id", "fingerprint", "component_id")]
    assert sorted(named, key=repr) == sorted(brute.simhash(texts()), key=repr)
    keepers = got.where("keeper")
    assert keepers.count() == brute.components_of({f for _, f, _ in named})
    assert keepers.where("not doc_id <=> component_id").count() == 0
    assert simhash.kept(documents(spark)).count() == keepers.count()


def test_links_in_blocks(spark, monkeypatch):
    """Lists longer than a block, compared block by block, connect what all pairs connect."""
    monkeypatch.setattr(simhash, "BLOCK", 8)
    pick = random.Random(5)
    centres = [pick.getrandbits(64) for _ in range(3)]
    prints = {c for c in centres}
    while len(prints) < 150:
        prints.add(pick.choice(sorted(prints)) ^ sum(1 << b for b in pick.sample(range(64), pick.randint(1, 5))))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = {r.node: r.root for r in components(simhash.links(spark.createDataFrame([(p,) for p in signed], "print long"))).collect()}
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[root(i)] = root(j)
    groups = {}
    for i, p in enumerate(signed):
        groups.setdefault(root(i), []).append(p)
    assert all(found.get(p, p) == min(g) for g in groups.values() for p in g)


def test_index_of_fingerprints_is_never_broadcast(spark):
    """Spark takes the table of prints for small, and `explode` makes 70 rows of each."""
    prints = spark.range(1000).select(F.xxhash64("id").alias("print"))
    plan = simhash.links(prints)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    near = spark.createDataFrame([(0,), (1,), (255,), (1 << 40,)], "print long")
    found = {tuple(r) for r in components(simhash.links(near)).collect()}
    assert found == {(1, 0), (1 << 40, 0)}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 50)}


def test_personal_data(spark):
    pick = random.Random(2)
    alphabet = ["a@b.cc", "@", ".", "1.2.3.4", "256", "4111 1111 1111 1111", "-", " ", "+49 (30) 123-4567", "12345", "é", "x_y@d-e.f.g", "..", "+1"]
    made = [(i, "".join(pick.choice(alphabet) for _ in range(pick.randint(1, 25)))) for i in range(400)]
    made += [(500, "9" * 3000), (501, "a" * 3000 + "@"), (502, "1." * 2000), (503, "+1 " * 500)]
    got = pii.find(documents(spark, made + texts())).select("doc_id", "text", "spans").collect()
    for r in got:
        assert [(pii.KINDS[s.kind], s.start, s.end) for s in r.spans if s.kind < 4] == brute.personal(r.text)
        assert all((r.text or "")[s.start : s.end] == s.value for s in r.spans if s.kind < 4)


def test_terms_that_give_an_entity_away(spark):
    made = [(i, f"In year {word} Quetzal wrote from kim@post.org about {word} things") for i, word in enumerate(("maps", "birds", "roads"))]
    made += [(10 + i, f"text about {word} without anybody in year seven") for i, word in enumerate(("maps", "birds", "roads", "cars"))]
    made += [(20 + i, made[0][1]) for i in range(3)] + [(30, "Reach lone@post.org and Solitary once")]
    got = {r.doc_id: r for r in pii.find(documents(spark, made)).collect()}
    assert {s.value for s in got[1].spans if s.kind >= 4} >= {"quetzal"}
    assert got[1].clean_text.startswith("In year birds") and "Quetzal" not in got[1].clean_text and "[EMAIL]" in got[1].clean_text
    assert [s.kind for s in got[30].spans] == [0]
    assert not any(s.kind >= 4 for i in range(10, 14) for s in got[i].spans)


@pytest.mark.parametrize("window, crowd", [(50, 2000), (50, 1), (20, 2000)])
def test_substrings(spark, window, crowd):
    got = substring.dedupe(documents(spark), window=window, crowd=crowd).collect()
    plain = sorted(((r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept_text)) for r in got), key=repr)
    assert plain == sorted(brute.repeats(texts(), window), key=repr)


def test_common_passage_is_one_piece_whatever_surrounds_it(spark):
    passage = [f"p{i}" for i in range(60)]
    rows = [(n, " ".join([*(f"a{n}x{i}" for i in range(40)), *passage, *(f"b{n}x{i}" for i in range(40))])) for n in range(40)]
    # Windows that only some of the documents have.
    rows += [(100 + n, " ".join([*(f"c{n}x{i}" for i in range(40)), *passage[:55], *(f"d{n % 3}x{i}" for i in range(40))])) for n in range(9)]
    for crowd in (2000, 5, 1):
        with tables_made() as paths:
            got = substring.dedupe(documents(spark, rows), crowd=crowd).collect()
        assert sorted((r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept_text)) for r in got) == sorted(brute.repeats(rows))
        found = next(p for p in paths if "/found-" in p)
        assert spark.read.parquet(found).count() <= 2 * len(rows)
        if crowd == 5:
            assert spark.read.parquet(next(p for p in paths if "/pieces-" in p)).count() < 30


def test_crowded_anchors_make_no_row_per_window(spark):
    passage, pick = [f"p{i}" for i in range(90)], random.Random(8)
    rows = []
    for n in range(60):
        low, high = pick.randint(0, 20), pick.randint(70, 90)
        rows.append((n, " ".join([*(f"a{n % 7}x{i}" for i in range(pick.randint(0, 40))), *passage[low:high], *(f"b{n % 5}x{i}" for i in range(40))])))
    # Short texts in which an anchor comes again.
    around = [f"r{i}" for i in range(24)] * 4
    rows += [(200 + n, " ".join(around[n % 24 : n % 24 + 50 + n % 13])) for n in range(40)]
    for crowd in (2000, 4):
        with tables_made() as paths:
            got = substring.dedupe(documents(spark, rows), crowd=crowd).collect()
        assert sorted((r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept_text)) for r in got) == sorted(brute.repeats(rows))
        read = {p: spark.read.parquet(p) for p in paths}
        windows = sum(max(0, len(text.split()) - 49) for _, text in rows)
        if crowd == 4:
            halves = [t for p, t in read.items() if "/halves-" in p]
            assert halves and all(t.groupBy("hash", "digest").count().where("count > 2").isEmpty() for t in halves)
        assert all(t.count() < windows for t in read.values())


def test_matching_statistics():
    pick = random.Random(3)
    for _ in range(60):
        pieces = [np.array([pick.randint(0, 2) for _ in range(pick.randint(1, 20))]) for _ in range(pick.randint(1, 6))]
        owners = np.array([pick.randint(0, 3) for _ in pieces])
        got = Index(pieces, owners).matches(pieces, owners, 6)

        def occurs(part, owner):
            return any(o < owner and any(p[i : i + len(part)].tolist() == part for i in range(len(p))) for p, o in zip(pieces, owners))

        for p, o, g in zip(pieces, owners, got):
            for i in range(len(p)):
                n = 0
                while i + n < len(p) and n < 6 and occurs(p[i : i + n + 1].tolist(), o):
                    n += 1
                assert g[i] == n


def test_bpe_round_trip(spark):
    from tokenizers import Tokenizer

    own, pick = Tokenizer.from_file(WORDS), random.Random(4)
    alphabet = ["a", "B", "é", "é", " ", "\n", "\x1c", " ", "日本", "'s", "<|endoftext|>", "<|", "...", "12", "İ", "Σ", "😀", "́"]
    made = [(i, "".join(pick.choice(alphabet) for _ in range(pick.randint(0, 400)))) for i in range(60)]
    made += [(100 + i, made[i][1] * 3) for i in range(20)] + [(200, "x" * 9000), (201, "x" * 9000), (202, " " * 5000)]
    made += [(300 + i, " ".join(f"word{j}" for j in range(i, 900))) for i in range(5)] + texts()
    docs = documents(spark, made)
    got = bpe.encode(docs, WORDS).withColumn("back", bpe.decoded("ids", WORDS)).collect()
    assert len(got) == len(made)
    for r in got:
        ids = own.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u2").tolist() == ids
        assert r.back == own.decode(ids, skip_special_tokens=False)


def test_bpe_derives_in_the_worker_that_encodes(spark):
    from hirelake.llm import queries

    made = [(i, " ".join(f"word{j}" for j in range(i, 900))) for i in range(5)] + [(9, "alone"), (10, None), (11, "")]
    length = bpe.Derived("n", "long", pa.int64(), lambda codec, ids: len(ids))
    got = bpe.encode(documents(spark, made), WORDS, each=length)
    assert sorted(r.doc_id for r in got.collect()) == sorted(i for i, _ in made)
    assert all(r.n == len(r.ids) for r in got.collect())
    # A Python step more would be a second worker per core, with a cache of its own.
    plan = queries.op5_bpe(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") <= 1


def test_bpe_cache_is_bounded_by_bytes():
    codec, longest = bpe.Codec(WORDS), 0
    for i in range(60):
        codec.words([b"%d" % (i * 100 + j) * 2000 for j in range(100)])
        longest = max(longest, sum(map(len, codec.cache)))
    assert longest < 2 * bpe.CACHED_BYTES


def test_text_without_agreement_is_encoded_whole(monkeypatch):
    from hirelake.llm.rolling import Rolling

    body = " ".join(f"word{i}" for i in range(3000)).encode()
    codec = bpe.codec_of(WORDS)
    ends = bpe.cuts(body, Rolling())[0]
    monkeypatch.setattr(bpe, "repaired", lambda *_: None)
    assert bpe.parts(codec, body, ends, np.ones(len(ends), bool)) == [(None, codec.raw(body.decode()), False, False)]


def test_chunks_are_shared_and_repaired(spark):
    from hirelake.llm.rolling import Rolling

    body = " ".join(f"word{j}" for j in range(4000)).encode()
    rolling, codec = Rolling(), bpe.Codec(WORDS)
    (ends_a, a), (ends_b, b) = bpe.cuts(body, rolling), bpe.cuts(b"another beginning " + body, rolling)
    assert len(a) > 5 and len(set(a) & set(b)) >= len(a) - 2
    assert any(body[e - 1 : e].isalnum() and body[e : e + 1].isalnum() for e in ends_a[:-1])
    made = b"".join(x[1] for x in bpe.parts(codec, body, ends_a, np.zeros(len(ends_a), bool)))
    assert made == codec.raw(body.decode())


def test_language_model(spark):
    for crowd in (1 << 20, 2):
        got = {(r.doc_id, r.text): r for r in lm.score(documents(spark), crowd=crowd).collect()}
        for (doc, text), (_, n, k, s) in zip(texts(), brute.scores(texts())):
            r = got[doc, text]
            assert (r.n_words, r.n_backoff) == (n, k)
            assert r.log_score is None if s is None else abs(r.log_score - s) < 1e-9
    one = lm.score(documents(spark, [(1, "a b c")])).first()
    assert (one.n_words, one.log_score) == (3, None)


def test_language_model_sends_a_pair_once_a_block_in_few_bytes(spark):
    pick = random.Random(4)
    rows = [(n, " ".join(f"w{pick.randint(0, 5000)}" for _ in range(3000))) for n in range(20)]
    rows += [(100 + n, " ".join(["very", "common"] * 300)) for n in range(100)]
    with tables_made() as paths:
        got = {r.doc_id: r for r in lm.score(documents(spark, rows)).collect()}
    for (doc, _), (_, n, k, s) in zip(rows, brute.scores(rows)):
        assert (got[doc].n_words, got[doc].n_backoff) == (n, k) and abs(got[doc].log_score - s) < 1e-9
    made = spark.read.parquet(next(p for p in paths if "/blocks-" in p))
    sent = made.select("block", "sizes", "words", "known").mapInArrow(lm._sent, "part int, block long, size long, digests binary, counts binary")
    sent = sent.selectExpr("sum(size) AS n", "sum(length(digests) + length(counts)) AS bytes").first()
    distinct = len({p for _, t in rows for p in zip(t.split(), t.split()[1:])}) + len({w for _, t in rows for w in t.split()})
    assert distinct <= sent.n <= distinct * made.count() and sent.bytes < 9 * sent.n


def test_whole_numbers_come_back_from_as_few_bytes_as_hold_them():
    values = np.array([0, 3, 255, 256, 1 << 40, (1 << 64) - 1, 7], dtype=np.uint64)
    ends = [2, 4, 6, 7]
    data = lm.narrow(values, ends).to_pylist()
    assert [len(x) for x in data] == [2, 4, 16, 1]
    assert np.concatenate([lm.widened(x, n) for x, n in zip(data, [2, 2, 2, 1])]).tolist() == values.tolist()


def der(tag, *parts):
    body = b"".join(parts)
    size = bytes([len(body)]) if len(body) < 128 else b"\x82" + len(body).to_bytes(2, "big")
    return bytes([tag]) + size + body


def test_confirmed_secrets(spark):
    number = lambda n: der(2, b"\x01" * n)
    rsa = der(0x30, der(2, b"\0"), *(number(n) for n in (64, 3, 64, 32, 32, 32, 32, 32)))
    pkcs8 = der(0x30, der(2, b"\0"), der(0x30, der(6, b"\x2a\x86\x48")), der(4, rsa))
    ec = der(0x30, der(2, b"\x01"), der(4, b"\x07" * 32), der(0xA0, der(6, b"\x2b\x81\x04")))
    field = lambda b: len(b).to_bytes(4, "big") + b
    ssh = secrets.OPENSSH + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + field(b"p" * 51) + field(b"s" * 90)
    url = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).rstrip(b"=").decode()
    token = f"{url({'alg': 'HS256'})}.{url({'sub': 'me'})}.c2lnbmF0dXJl"
    b64 = lambda x: base64.b64encode(x).decode()
    pem = "-----BEGIN PRIVATE KEY-----\n" + "\n".join(b64(pkcs8)[i : i + 64] for i in range(0, len(b64(pkcs8)), 64)) + "\n-----END PRIVATE KEY-----"
    good = [(3, b64(rsa)), (3, b64(pkcs8)), (3, b64(ec)), (4, b64(ssh)), (5, token), (3, rsa.hex().upper()), (3, pem)]
    bad = [b64(rsa + b"\0"), b64(rsa[:-1]), b64(ssh + b"x"), b64(bytes(range(120))), token.replace(".", "x."), "A" * 500, rsa.hex().upper()[:-2]]
    docs = documents(spark, [(i, f"see {x} there") for i, x in enumerate([g for _, g in good] + bad)])
    got = {r.doc_id: [s for s in r.spans if s.kind > 2] for r in secrets.find(docs).collect()}
    for i, (kind, text) in enumerate(good):
        assert [(s.kind, s.start, s.end) for s in got[i]] == [(kind, 4, 4 + len(text))]
    assert not any(got[len(good) + i] for i in range(len(bad)))


def test_secret_patterns(spark):
    pick = random.Random(6)
    alphabet = ["password", "PassWD", "Secret", "ſecret", "toKen", "api_key", "APIKEY", "=", ":", " ", '"', "'", "abcdef", "x", "AKIA", "Z9" * 9, "deadbeef" * 3, "é", "\n"]
    made = [(i, "".join(pick.choice(alphabet) for _ in range(pick.randint(1, 20)))) for i in range(600)] + texts()
    for r in secrets.find(documents(spark, made)).collect():
        assert [(secrets.KINDS[s.kind], s.start, s.end) for s in r.spans if s.kind < 3] == brute.secrets(r.text)


def test_decontamination(spark):
    made, df = items(spark)
    got = decontam.check(documents(spark), df).collect()
    plain = [(r.doc_id, r.n_words, r.n_hit, r.n_items, brute.sha(",".join(r["items"])), r.contaminated) for r in got]
    assert sorted(plain, key=repr) == sorted(brute.leaks(texts(), made), key=repr)
    assert any(r.contaminated for r in got) and not all(r.contaminated for r in got)


def test_lines(spark):
    pick = random.Random(8)
    stock = ["".join(pick.choice("abé ") for _ in range(pick.randint(18, 30))) for _ in range(12)]

    def edit(x):
        at, kind = pick.randrange(len(x)), pick.randrange(4)
        return x if kind == 0 else x[:at] + ("" if kind == 1 else "z" if kind == 2 else "z" + x[at]) + x[at + 1 :]

    made = [(pick.randrange(60), "\n".join(edit(pick.choice(stock)) for _ in range(pick.randint(1, 6)))) for _ in range(80)]
    made += [(None, made[0][1]), (61, None), (62, ""), (63, "\n\n")] + [(70 + i, t) for i, (_, t) in enumerate(made[:5])]
    for whole in (made, texts()):
        got = lines.dedupe(documents(spark, whole)).collect()
        plain = sorted(((r.doc_id, r.n_removed, r.kept_text or "") for r in got), key=repr)
        assert plain == sorted(brute.lines(whole), key=repr)
    assert lines.deduped(documents(spark, made)).columns == documents(spark, made).columns


def test_lines_and_their_variants_are_never_broadcast(spark, monkeypatch):
    """Spark takes all variants of a line for one row, and equal hashes for the little that they take on disk."""
    plans, real = {}, lines.written

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, name)

    monkeypatch.setattr(lines, "written", seen)
    whole = [(1, "a line that is long enough\nanother line of the text"), (2, "a line that is long enouqh"), (3, "a line thatt is long enouqh")]
    got = lines.dedupe(spark.createDataFrame(whole, "doc_id long, text string"), carry=["doc_id"])
    assert rows(got, "doc_id", "n_removed") == [(1, 0), (2, 1), (3, 1)]
    assert "LeftOuter, BuildRight" in plans["variants"] and "BuildLeft" not in plans["variants"]
    assert plans["partners"].count("SortMergeJoin") == 3 and plans["removed-lines"].count("SortMergeJoin") == 1


def test_conversations(spark):
    pick = random.Random(9)
    alphabet = ["<", "|", "<|turn|>", "<\\|end|>", "</s>", "[INST]", "\\", "é", "日本", "\n", " ", "😀", "<|endoftext|>", "plain words"]
    turns = []
    for conv in range(40):
        for turn in range(pick.randint(1, 6)):
            turns.append((conv, turn, pick.choice(["user", "assistant", "sys<|text|>", None]), "".join(pick.choices(alphabet, k=pick.randint(0, 9)))))
    turns += [(50, 0, "user", None), (50, 1, "assistant", None), (None, 1, "assistant", "late"), (None, None, "user", "first"), (51, 0, "user", "b"), (51, 0, "assistant", "a")]
    turns += [(52, 0, "assistant", "again"), (52, 0, "assistant", "again"), (53, 0, "assistant", "long " * 30_000)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    own = chat.Formatter(BYTES, chat.Template())
    least = lambda x: (x is not None, x or 0) if not isinstance(x, str) else (True, x)
    got = {r.conv_id: r for r in chat.format_conversations(df, BYTES).collect()}
    assert set(got) == {t[0] for t in turns}
    for conv, r in got.items():
        ordered = sorted((t[1:] for t in turns if t[0] == conv), key=lambda t: (least(t[0]), least(t[1]), least(t[2])))
        wanted = [(role or "", text or "") for _, role, text in ordered]
        assert own.parse(r.formatted) == wanted
        arrays = (np.array(x) for x in (r.starts, r.ends, r.loss))
        assert "".join(own.masked(r.formatted, *arrays)) == "".join(t for role, t in wanted if role == "assistant")
        assert own.tokenizer.encode(r.formatted, add_special_tokens=False).ids == r["ids"]
        assert [own.unescape(r.formatted[s.start : s.end]) for s in r.spans] == [t for _, t in wanted]


def test_control_strings_must_not_overlap_their_escape():
    with pytest.raises(ValueError):
        chat.Template(turn="a\\b").control()
