"""Small tables with the awkward cases in them."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names clash with those that operators add or use.
CLASHES = ("spans", "kept", "fingerprint", "n_words", "ids", "_in", "_text", "_row", "row", "h1", "n_removed", "items")


def prose(seed, n, words=400):
    pick = random.Random(seed)
    stock = ["".join(pick.choice("abcdeßéñ日") for _ in range(pick.randint(2, 9))) for _ in range(words)]
    return [pick.choice(stock) + pick.choice(["", "", "", ".", ","]) for _ in range(n)]


def texts():
    """(doc_id, text): nulls, blanks, copies, near copies, shared passages, ties, a long text."""
    pick = random.Random(7)
    base = [prose(i, pick.randint(3, 160)) for i in range(30)]
    passage = prose(99, 75)
    rows = [(i, " ".join(w)) for i, w in enumerate(base)]
    for i in range(12):
        near = list(base[i])
        near[pick.randrange(len(near))] = "changed"
        rows.append((100 + i, "  ".join(near)))
        at = pick.randrange(len(base[i]) + 1)
        rows.append((200 + i, "\n".join([" ".join(base[-i][:at]), " ".join(passage), " ".join(base[-i][at:])])))
    line = "A line of boilerplate that stands in many places"
    rows += [(300 + i, f"{line}\n{' '.join(prose(500 + i, 30))}\n{line}{'.' * (i % 2)}\n{line[:-1]}") for i in range(8)]
    rows += [(400, None), (401, ""), (402, " \n\t "), (403, "x"), (404, "one two three"), (405, "a a a a " * 60)]
    rows += [(None, " ".join(base[0])), (None, None), (5, " ".join(base[5])), (5, "other text " + " ".join(base[6]))]
    rows += [(406, " ".join(base[2])), (406, " ".join(base[2]))]
    rows += [(407, " ".join(prose(1234, 30_000, 3000)))]
    return rows


def documents(spark, rows=None, clash=()):
    langs, sources = ("en", "de", None), ("s0", "s1", "s2", None)
    made = [
        (d, t, langs[i % 3], sources[i % 4], None if t is None else len(t)) + tuple(f"own {c}" for c in clash)
        for i, (d, t) in enumerate(texts() if rows is None else rows)
    ]
    return spark.createDataFrame(made, SCHEMA + "".join(f", `{c}` string" for c in clash))
