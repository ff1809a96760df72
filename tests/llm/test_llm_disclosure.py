"""Terms far from the entity, short ones, ones with digits, and in documents without the entity."""

import math
import random
from collections import Counter, defaultdict

import brute
import pytest
import regex
from cases import documents

from hirelake.llm import pii


def test_terms_are_marked_wherever_they_stand(spark):
    far = "and some more common words follow here " * 6
    made = [(i, f"{who} Li of unit B7 wrote {far}to kim@post.org, as {who} said") for i, who in enumerate(("one", "two", "three", "four"))]
    made += [(10 + i, f"{who} {far}of unit as said wrote to {i}") for i, who in enumerate(("one", "two", "three", "four") * 15)]
    made += [(90, f"here LI met {far}and then Li again, said one of unit B7")]
    got = {r.doc_id: r for r in pii.find(documents(spark, made)).collect()}
    terms = lambda d: [s.value for s in got[d].spans if s.kind >= 4]
    assert set(terms(0)) == {"li", "b7"}
    assert sorted(terms(90)) == ["b7", "li", "li"]
    for s in got[90].spans:
        assert got[90].text[s.start : s.end].lower() == s.value
    assert "Li" not in got[90].clean_text and "LI" not in got[90].clean_text and "B7" not in got[90].clean_text
    assert not any(terms(10 + i) for i in range(60))


def disclosing(texts, limits):
    """term -> kind by the rule of the module, over all pairs; each entity at most once a text."""
    entities, said, both = defaultdict(Counter), Counter(), defaultdict(Counter)
    for text in texts:
        spans = brute.personal(text)
        masked = list(text)
        for _, start, end in spans:
            masked[start:end] = " " * (end - start)
        words = {w.lower() for w in regex.findall(r"[\p{L}\p{M}\p{N}]+", "".join(masked))}
        said.update(words)
        for _, start, end in spans:
            before, after = text[max(0, start - limits.reach) : start], text[end : end + limits.reach]
            if start > limits.reach:
                before = regex.sub(r"^\p{L}+", "", before)
            if len(after) == limits.reach:
                after = regex.sub(r"\p{L}+$", "", after)
            context = (before.lower(), after.lower())
            entities[text[start:end].lower()][context] += 1
            for word in words:
                both[text[start:end].lower(), word][context] += 1
    found = defaultdict(float)
    for (entity, word), contexts in both.items():
        with_entity, n = sum(entities[entity].values()), len(texts)
        if len(entities[entity]) < limits.min_contexts or len(contexts) < limits.min_contexts or with_entity == n:
            continue
        share = math.log2(contexts.total() * n / (with_entity * said[word])) / math.log2(n / with_entity)
        found[word] = max(found[word], share)
    return {w: "remove" if x >= limits.remove_at else "generalise" for w, x in found.items() if x >= limits.generalise_at}


@pytest.mark.parametrize("common, slots", [(1 << 16, 1 << 18), (5, 4), (1, 1)])
def test_terms_against_all_pairs(spark, monkeypatch, common, slots):
    monkeypatch.setattr(pii, "COMMON", common)
    monkeypatch.setattr(pii, "SLOTS", slots)
    pick = random.Random(11)
    stock = [f"w{i}é" if i % 3 else f"Word{i}" for i in range(150)]
    own = {f"{name}@post.org": pick.sample(stock, 3) + [name.title()] for name in ("kim", "lee", "ann", "bob", "eve")}
    made = []
    for i in range(160):
        words = [stock[min(int(pick.expovariate(0.04)), 149)] for _ in range(pick.randint(5, 40))]
        for who in pick.sample(sorted(own), pick.choice([0, 0, 1, 1, 2])):
            words += [w for w in own[who] if pick.random() < 0.9]
            words.insert(pick.randrange(len(words)), who)
        made.append((i, pick.choice([" ", ", ", "\x01 "]).join(words)))
    made += [(200 + i, made[3][1]) for i in range(5)]
    limits = pii.Limits()
    want = disclosing([t for _, t in made], limits)
    assert {"remove", "generalise"} <= set(want.values())
    got = pii.find(documents(spark, made), limits=limits).collect()
    for r in got:
        spans = brute.personal(r.text)
        masked = list(r.text)
        for _, start, end in spans:
            masked[start:end] = " " * (end - start)
        places = [(m.start(), m.end(), want.get(m[0].lower())) for m in regex.finditer(r"[\p{L}\p{M}\p{N}]+", "".join(masked))]
        assert [(s.start, s.end, pii.KINDS[s.kind]) for s in r.spans if s.kind >= 4] == sorted(
            (p for p in places if p[2]), key=lambda p: (p[2], p[0])
        )
