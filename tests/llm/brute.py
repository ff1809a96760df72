"""Plain Python versions of the contracts, for small tables."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            repeated |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 50 or 100 * len(repeated) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated), failed


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text):
    """Base spans: (kind, start, end) by kind, then start."""
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, p, ok in rules for m in re.finditer(p, text) if ok(m)]


def secrets(text):
    """Base spans: (kind, start, end) by start, then kind."""
    text = text or ""
    rules = [
        ("assign", r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    ]
    found = [(m.start(), i, k, m.end()) for i, (k, p, ok) in enumerate(rules) for m in re.finditer(p, text) if ok(m)]
    return [(k, s, e) for s, _, k, e in sorted(found)]


def spans(found):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in found)


def fingerprint(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(rows):
    """{row number: (fingerprint, component)} of (doc_id, text) rows; ids may be null."""
    prints = [fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = root(i)
        if doc is not None:
            least[r] = min(least.get(r, doc), doc)
    return [(doc, f"{prints[i]:016x}", least.get(root(i))) for i, (doc, _) in enumerate(rows)]


def components_of(prints):
    """Number of components of fingerprints given in hex."""
    left, count = {int(p, 16) for p in prints}, 0
    while left:
        found, count = [left.pop()], count + 1
        for p in found:
            near = {q for q in left if (p ^ q).bit_count() <= 4}
            left -= near
            found += near
    return count


def repeats(rows, window=50):
    """(doc_id, n_words, n_removed, kept) of (doc_id, text) rows."""
    words = [WORD.findall(t or "") for _, t in rows]
    first = {}
    for (doc, _), w in zip(rows, words):
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if doc is not None:
                first[key] = min(first.get(key, doc), doc)
    out = []
    for (doc, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            least = first.get(tuple(w[i : i + window]))
            if doc is not None and least is not None and least < doc:
                gone |= set(range(i, i + window))
        out.append((doc, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def leaks(rows, items, window=10):
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of (doc_id, text) rows."""
    lower = lambda t: re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")
    keys = {}
    for item, text in items:
        w = ITEM_WORD.findall(lower(text))
        size = min(len(w), window)
        for i in range(len(w) - size + 1 if w else 0):
            keys.setdefault(size, {}).setdefault(tuple(w[i : i + size]), set()).add(item)
    out = []
    for doc, text in rows:
        w, hit, found = ITEM_WORD.findall(lower(text)), set(), set()
        for size, table in keys.items():
            for i in range(len(w) - size + 1):
                if got := table.get(tuple(w[i : i + size])):
                    found |= got
                    hit |= set(range(i, i + size))
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((doc, len(w), len(hit), len(found), sha(ids), bool(hit)))
    return out


def chat(turns):
    """(turns_sha256, loss_chars, loss_sha256) of (role, text) turns in order."""
    both = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return sha(both), len(loss), sha(loss)


def within_one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    s = 0
    while s < min(len(a), len(b)) - p and a[-1 - s] == b[-1 - s]:
        s += 1
    return max(len(a), len(b)) - p - s <= 1


def lines(rows, min_chars=20):
    """(doc_id, n_removed, kept text) of (doc_id, text) rows."""
    places, plain = {}, lambda x: " ".join(x.lower().split())
    tie = lambda t: int.from_bytes(hashlib.sha256((t or "").encode()).digest()[:8], "big", signed=True)
    for doc, text in rows:
        for i, line in enumerate(text.split("\n") if text else ()):
            if plain(line):
                at = (doc is None, doc or 0, tie(text), i)
                places[plain(line)] = min(places.get(plain(line), at), at)
    by_size = {}
    for x in (p for p in places if len(p) >= min_chars):
        by_size.setdefault(len(x), []).append(x)
    near = lambda x, n: by_size.get(len(x) + n, ()) if len(x) >= min_chars else ()
    best = {
        x: min([places[x]] + [places[y] for n in (-1, 0, 1) for y in near(x, n) if within_one_edit(x, y)])
        for x in places
    }
    out = []
    for doc, text in rows:
        kept, gone = [], 0
        for i, line in enumerate(text.split("\n") if text else ()):
            at = (doc is None, doc or 0, tie(text), i)
            if plain(line) in best and best[plain(line)] < at:
                gone += 1
            else:
                kept.append(line)
        out.append((doc, gone, "\n".join(kept)))
    return out


def scores(rows, alpha=0.4):
    """(doc_id, n_words, n_backoff, log score per word) of (doc_id, text) rows."""
    import math

    words = [[w.decode() for w in (t or "").encode().lower().split()] for _, t in rows]
    c1, c2 = Counter(x for w in words for x in w), Counter(p for w in words for p in zip(w, w[1:]))
    total, out = sum(c1.values()), []
    for (doc, _), w in zip(rows, words):
        o1, o2, n = Counter(w), Counter(zip(w, w[1:])), total - len(w)
        s = k = 0
        for i, x in enumerate(w):
            if i and c2[w[i - 1], x] > o2[w[i - 1], x]:
                s += math.log(c2[w[i - 1], x] - o2[w[i - 1], x]) - math.log(c1[w[i - 1]] - o1[w[i - 1]])
                continue
            k += 1
            seen = c1[x] - o1[x]
            s += (math.log(alpha) if i else 0) + (math.log(seen) if seen else math.log(alpha)) - (math.log(n) if n else 0)
        out.append((doc, len(w), k, s / len(w) if w and n else None))
    return out


def robust(rows, rules):
    """kept per row of (text, lang, source): the base rule, then the fit by numpy."""
    import json
    import math

    import numpy as np

    from hirelake.llm import quality as q

    stats = [quality(t) for t, _, _ in rows]
    good = [i for i, s in enumerate(stats) if not s[5]]
    groups = {}
    for i in good:
        for name in ((), rows[i][1:2], rows[i][1:3]):
            groups.setdefault(tuple(name), []).append(i)

    def vector(i):
        n, chars, symbols, dup, rep, _ = stats[i]
        lines = sum(1 for x in (rows[i][0] or "").split("\n") if WORD.search(x))
        raw = (math.log(chars / n), math.sqrt(symbols / chars), math.sqrt(dup / lines), math.sqrt(rep / n))
        return [math.floor(x * q.UNIT + 0.5) for x in raw]

    kept = [not s[5] for s in stats]
    floors = np.diag([(f * q.UNIT) ** 2 for f in rules.floors])
    fits = {}
    for name in sorted(groups, key=len):
        members = groups[name]
        x = np.array([vector(i) for i in members], dtype=float)
        n = len(x)
        middle = []
        for k in range(q.AXES):
            bins = np.sort(np.floor(x[:, k] / 100))
            middle.append(bins[math.ceil(0.5 * n) - 1] * 100 + 50)
        centre, cov = np.array(middle), floors
        for _ in range(rules.steps):
            d = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov), x - centre)
            bins = np.floor(np.log(d + 1e-6) * 32)
            near = x[bins <= np.sort(bins)[math.ceil(rules.share * n) - 1]]
            centre = near.mean(axis=0)
            cov = (near.T @ near / len(near) - np.outer(centre, centre)) * q.consistency(rules.share) + floors
        if name:
            w, (up, spread) = n / (n + rules.pull), fits[name[:-1]]
            gap = centre - up
            centre, cov = w * centre + (1 - w) * up, w * cov + (1 - w) * spread + w * (1 - w) * np.outer(gap, gap)
        fits[name] = centre, cov
        if len(name) == 2:
            d = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov), x - centre)
            for i, far in zip(members, d > q.quantile(1 - rules.reject)):
                kept[i] = not far
    return kept
