"""HTML to a node array (one Arrow UDF) and selectors over that array (built-in functions).

A node is `struct<step, text, attrs, up, depth, size>`; array order is document order. An element
node has null text and its own step of a path, `/tag[n,m]#id.class1.class2.`, n being the element's
place among its sibling elements and m its place among those of the same tag. A text node has a
null step. `up` is how many nodes further in front the parent element stands (for a text: the
element it is directly in), 0 where that is not in the array; `depth` counts the element and its
ancestors. `size` is the number of nodes of the subtree, so what is inside an element is a
slice of the array. All three are relative, so that a slice is a node array again.

Ancestors are found by following `up`, and only for nodes whose own step fits the end of the
selector; deep pages therefore cost no more to hold than flat ones.

Selectors are compiled on the driver to one regular expression per part, for a step. The
vocabulary is tag, `*`, #id, .class, [class*=part], :nth-child(n), :nth-of-type(m),
descendant and child combinators, ending in `::text`, ` *::text`, `::attr(name)` or ` *::attr(name)`.

Only nodes inside the regions named by the selectors leave the UDF, and only the asked
for attributes, so what crosses back to the JVM stays near the size of those regions.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable
from html import unescape
from itertools import batched

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.functions import lists

# The UDFs travel whole, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODE_TYPE = T.ArrayType(
    T.StructType()
    .add("step", "string")
    .add("text", "string")
    .add("attrs", T.MapType(T.StringType(), T.StringType()))
    .add("up", "integer")
    .add("depth", "integer")
    .add("size", "integer")
)
_ARROW_NODE = pa.struct([
    ("step", pa.string()), ("text", pa.string()), ("attrs", pa.map_(pa.string(), pa.string())),
    ("up", pa.int32()), ("depth", pa.int32()), ("size", pa.int32()),
])

_MARKUP = re.compile(
    # A tag ends before the next `<`, so a page of unclosed ones is still read in linear time.
    r"<!--.*?(?:-->|\Z)|<[!?][^<>]*>"
    r"|<(script|style|textarea|title)\b([^<>]*)>(.*?)(?:</\1\s*>|\Z)"
    r"|</([A-Za-z][^\s/<>]*)[^<>]*>"
    r"|<([A-Za-z][^\s/<>]*)([^<>\"']*+(?:(?:\"[^\"]*\"|'[^']*')[^<>\"']*+)*+|[^<>]*)>",
    re.S | re.I,
)
# Groups of _MARKUP by its lastindex: content elements, end tags, start tags.
_CONTENT, _END, _START = 3, 4, 6
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S)
_RESERVED = re.compile(r"[/#.\[\]%]")

# Elements of HTML that have no end tag, whose content is not shown, and
# that end an open element of the listed kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = ("script", "style")
# Pages whose parts a Python worker holds at a time.
PAGES_AT_ONCE = 64
BLOCKS = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr"
    " main nav ol p pre section table ul".split()
)
ENDS = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}


def _encoded(name: str) -> str:
    return _RESERVED.sub(lambda m: f"%{ord(m[0]):02X}", name)


def _attributes(source: str) -> dict[str, str]:
    found = {}
    for name, double, single, bare in _ATTR.findall(source):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


class _Picks:
    """What the selectors of `html_fields` match, picked out as a page is walked. Every part of every
    selector has a bit; an element carries the bits of the parts that end at it and of those that end at
    it or around it, so its own bits follow from its parent's, whatever the depth."""

    def __init__(self, selectors: Iterable[str] = (), attrs: tuple = ()) -> None:
        self.parts: list[tuple[int, tuple, int, int]] = []
        self.first = self.child = self.below = 0
        #: By kind: bits that match the element itself, bits that match around it.
        self.masks = {kind: [0, 0] for kind in ("element", "text", "attr")}
        self.targets: dict[int, tuple[int, str | None]] = {}
        self.found: list[list] = []
        self._known: dict[int, list] = {}
        bit = 1
        for column, selector in enumerate(selectors):
            css, deep, attr = _target(selector)
            for j, (link, compound) in enumerate(_compounds(css)):
                p = _parts(compound)
                wanted = (p["tag"], p["id"], p["classes"], p["part"])
                self.parts.append((bit, wanted, int(p["nth"] or 0), int(p["typed"] or 0)))
                self.first |= bit if not j else 0
                self.child |= bit if j and link == ">" else 0
                self.below |= bit if j and link != ">" else 0
                last, bit = bit, bit << 1
            kind = "element" if _names_elements(selector) else "text" if attr is None else "attr"
            self.masks[kind][deep] |= last
            self.targets[last] = (column, attr)
            self.found.append([])
        self.attrs = tuple(dict.fromkeys([*attrs, *(a for _, a in self.targets.values() if a)]))

    def own(self, tag: str, ident: str, classes: list[str]) -> tuple[int, list]:
        """Parts that a start tag fits wherever it stands, and those that also ask for its place."""
        fits = [part for part in self.parts if _in_region(part[1], tag, ident, classes)]
        placed = [(bit, nth, typed) for bit, _, nth, typed in fits if nth or typed]
        return sum(bit for bit, _, nth, typed in fits if not (nth or typed)), placed

    def hits(self, kind: str, exact: int, around: int) -> list[tuple[list, str | None]]:
        """The lists that take a value of this kind from an element, each with its attribute."""
        here, over = self.masks[kind]
        hit = exact & here | around & over
        if not hit:
            return []
        known = self._known.get(hit)
        if known is None:
            known = self._known[hit] = [(self.found[c], a) for bit, (c, a) in self.targets.items() if hit & bit]
        return known


def _start_tag(tag: str, source: str, regions: tuple, picks: _Picks) -> tuple[str, str, bool, dict, int, list]:
    """(tag, rest of its step, opens a region, wanted attributes, parts it fits, parts it may fit by place)"""
    tag = tag.lower()
    given = _attributes(source) if source.strip() else {}
    ident, classes = given.get("id", ""), given.get("class", "").split()
    rest = (f"#{_encoded(ident)}" if ident else "") + "." + "".join(f"{_encoded(c)}." for c in classes)
    opens = any(_in_region(r, tag, ident, classes) for r in regions)
    return tag, rest, opens, {a: given[a] for a in picks.attrs if a in given}, *picks.own(tag, ident, classes)


class _Nodes:
    """The nodes of several pages as lists by field."""

    def __init__(self) -> None:
        self.steps: list[str | None] = []
        self.texts: list[str | None] = []
        self.attrs: list[dict | None] = []
        self.ups: list[int] = []
        self.depths: list[int] = []
        self.sizes: list[int] = []

    def add(self, step: str | None, text: str | None, given: dict | None, parent: int, depth: int) -> int:
        """`parent` is a place in the lists, or -1."""
        place = len(self.steps)
        self.steps.append(step)
        self.texts.append(text)
        self.attrs.append(given)
        self.ups.append(place - parent if parent >= 0 else 0)
        self.depths.append(depth)
        self.sizes.append(1)
        return place


class _Open:
    """The elements open at a place of the page, as a stack of [tag, children, children by tag,
    inside a region, place of its node or -1, depth, parts that end at it, parts that end at it or
    around it, lists its texts go to]. For each tag the places on the stack are
    kept, so the innermost open element of a kind is found without looking through the others."""

    def __init__(self, inside: bool, nodes: _Nodes) -> None:
        self.stack: list[list] = [["", 0, {}, inside, -1, 0, 0, 0, []]]
        self.places: dict[str, list[int]] = {}
        self.nodes = nodes

    def push(self, tag: str, *entry: object) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append([tag, 0, {}, *entry])

    def cut(self, length: int) -> None:
        """Close all but the outermost `length` entries."""
        while len(self.stack) > length:
            entry = self.stack.pop()
            tag, place = entry[0], entry[4]
            self.places[tag].pop()
            if place >= 0:
                self.nodes.sizes[place] = len(self.nodes.steps) - place

    def end(self, tag: str) -> None:
        """Close the innermost open element of the tag, if there is one."""
        at = self.places.get(tag)
        if at:
            self.cut(at[-1])

    def close(self, names: Iterable[str], stops: Iterable[str] = ()) -> bool:
        """Close the innermost open element of the names, unless a stop is open inside it."""
        at = max((self.places[n][-1] for n in names if self.places.get(n)), default=0)
        if not at or any(self.places[s][-1] > at for s in stops if self.places.get(s)):
            return False
        self.cut(at)
        return True


def _walk(html: str, regions: tuple | None, picks: _Picks, memo: dict, nodes: _Nodes) -> None:
    """Append the page's nodes and what it holds of the picks. `memo` keeps start tags already read,
    which repeat a lot. Without regions every node is kept, with None for them those of picked elements."""
    opened = _Open(regions == (), nodes)
    stack, places, pos, base = opened.stack, opened.places, 0, len(nodes.steps)
    first, child, below, hits = picks.first, picks.child, picks.below, picks.hits

    def add_text(text: str) -> None:
        top = stack[-1]
        if top[3]:
            nodes.add(None, text, None, top[4], top[5])
        for values, _ in top[8]:
            values.append(text)

    for hit in _MARKUP.finditer(html):
        start, end = hit.span()
        if start > pos and (stack[-1][3] or stack[-1][8]):
            add_text(unescape(html[pos:start]))
        pos = end
        kind = hit.lastindex
        if kind == _END:
            opened.end(hit[4].lower())
            continue
        if kind is None:
            continue
        source = hit.group(5, 6) if kind == _START else hit.group(1, 2)
        known = memo.get(source)
        if known is None:
            if len(memo) > 20_000:
                memo.clear()
            known = memo[source] = _start_tag(*source, regions or (), picks)
        tag, rest, opens, given, own, placed = known
        if tag in BLOCKS and places.get("p"):
            opened.close(("p",), ("button", "table", "td", "th"))
        if tag in ENDS:
            while opened.close(*ENDS[tag]):
                pass
        parent = stack[-1]
        parent[1] += 1
        nth = parent[2][tag] = parent[2].get(tag, 0) + 1
        for bit, n, m in placed:
            if n in (0, parent[1]) and m in (0, nth):
                own |= bit
        around = parent[7]
        exact = own and own & (first | (parent[6] << 1) & child | (around << 1) & below)
        takers = hits("text", exact, around) if exact or around else ()
        matched = hits("element", exact, 0) if exact else ()
        inside, place, depth = parent[3] or opens or bool(matched), -1, parent[5]
        if inside:
            depth += 1
            place = nodes.add(f"/{tag}[{parent[1]},{nth}]{rest}", None, given, parent[4], depth)
            for found, _ in matched:
                found.append(place - base)
        if given and (exact or around):
            for values, attr in hits("attr", exact, around):
                if attr in given:
                    values.append(given[attr])
        if kind == _CONTENT and hit[3] and (inside or takers):
            text = hit[3] if tag in UNSEEN else unescape(hit[3])
            if inside:
                nodes.add(None, text, None, place, depth)
                nodes.sizes[place] = 2
            for values, _ in takers:
                values.append(text)
        if kind == _START and tag not in VOID:
            opened.push(tag, inside, place, depth, exact, around | exact, takers)
    if pos < len(html) and (stack[-1][3] or stack[-1][8]):
        add_text(unescape(html[pos:]))
    opened.cut(1)


def _in_region(region: tuple, tag: str, ident: str, classes: list[str]) -> bool:
    want_tag, want_id, want_classes, part = region
    return (
        (not want_tag or want_tag == tag)
        and (not want_id or want_id == ident)
        and all(c in classes for c in want_classes)
        and (not part or any(part in c for c in classes))
    )


def _to_arrow(pages: Iterable[str | None], regions: tuple, attrs: tuple) -> pa.Array:
    return _read(pages, regions, _Picks(attrs=attrs))[0]


def _read(pages: Iterable[str | None], regions: tuple | None, picks: _Picks) -> list[pa.Array]:
    """The pages' nodes, then what they hold of each pick. A batch is read a few pages at a time, so
    that Python holds the parts of those only; what is read is kept in Arrow's form."""
    memo: dict = {}
    read = [_read_some(some, regions, picks, memo) for some in batched(pages, PAGES_AT_ONCE)]
    return [pa.concat_arrays(parts) for parts in zip(*read or [_read_some((), regions, picks, memo)], strict=True)]


def _read_some(pages: tuple[str | None, ...], regions: tuple | None, picks: _Picks, memo: dict) -> list[pa.Array]:
    nodes, page_ends, found_ends = _Nodes(), [0], [[0] for _ in picks.found]
    for found in picks.found:
        found.clear()
    for page in pages:
        _walk(page or "", regions, picks, memo, nodes)
        page_ends.append(len(nodes.steps))
        for ends, found in zip(found_ends, picks.found, strict=True):
            ends.append(len(found))
    kinds = [pa.int32() if bit & picks.masks["element"][0] else pa.string() for bit in picks.targets]
    picked = [
        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found, kind))
        for ends, found, kind in zip(found_ends, picks.found, kinds, strict=True)
    ]
    keys, values, map_ends = [], [], [0]
    for given in nodes.attrs:
        if given:
            keys.extend(given)
            values.extend(given.values())
        map_ends.append(len(keys))
    struct = pa.StructArray.from_arrays(
        [
            pa.array(nodes.steps, pa.string()),
            pa.array(nodes.texts, pa.string()),
            pa.MapArray.from_arrays(map_ends, pa.array(keys, pa.string()), pa.array(values, pa.string())),
            *(pa.array(numbers, pa.int32()) for numbers in (nodes.ups, nodes.depths, nodes.sizes)),
        ],
        fields=list(_ARROW_NODE),
    )
    return [pa.ListArray.from_arrays(pa.array(page_ends, pa.int32()), struct), *picked]


def html_nodes(html: Column, selectors: Iterable[str] = (), attrs: tuple = ("href", "aria-label")) -> Column:
    """Node array of a page, cut down to the regions the selectors can match.

    Without selectors every node is kept."""
    regions = tuple(dict.fromkeys(_region(s) for s in selectors))
    if any(not any(r) for r in regions):
        regions = ()

    @F.arrow_udf(NODE_TYPE)
    def nodes(pages: pa.Array) -> pa.Array:
        return _to_arrow((page.as_py() for page in pages), regions, attrs)

    return nodes(html)


def html_fields(html: Column, rules: dict[str, str], attrs: tuple = ("href", "aria-label")) -> Column:
    """What each rule matches on a page, read in one pass: a struct with, by the rule's name, the texts
    or attribute values in document order, or for a rule that names elements their places in the
    struct's `nodes`, the node array cut down to such elements. The same as select_all and
    elements give over html_nodes, without a search of the array for each rule."""
    names = ["nodes", *rules]
    schema = T.StructType().add("nodes", NODE_TYPE)
    for name, rule in rules.items():
        schema.add(name, T.ArrayType(T.IntegerType() if _names_elements(rule) else T.StringType()))

    @F.arrow_udf(schema)
    def fields(pages: pa.Array) -> pa.Array:
        read = _read((page.as_py() for page in pages), None, _Picks(rules.values(), attrs))
        return pa.StructArray.from_arrays(read, names)

    return fields(html)


@F.arrow_udf(T.StringType())
def html_text(fragments: pa.Array) -> pa.Array:
    """Plain text of an HTML fragment; script and style content is not text."""

    def plain(fragment: str) -> str:
        parts, pos = [], 0
        for hit in _MARKUP.finditer(fragment):
            parts.append(fragment[pos:hit.start()])
            if hit.lastindex == _CONTENT and hit[1].lower() not in UNSEEN:
                parts.append(hit[3])
            pos = hit.end()
        return unescape("".join([*parts, fragment[pos:]]))

    return pa.array([None if f is None else plain(f) for f in fragments.to_pylist()], pa.string())


# --- selectors -------------------------------------------------------------------

NUMBER = r"\d+"
_COMPOUND = re.compile(
    r"(?P<tag>\*|[A-Za-z][\w-]*)?(?P<rest>(?:#[\w-]+|\.[\w-]+|\[class\*=[\w-]+\]|:nth-child\(\d+\)|:nth-of-type\(\d+\))*)$"
)
_HIDDEN = r"^/(script|style)\["
_TARGET = re.compile(r"^(?P<css>.*?)(?P<deep>\s+\*?)?::(?:(?P<text>text)|attr\((?P<attr>[\w-]+)\))$")


def _parts(compound: str) -> dict:
    hit = _COMPOUND.match(compound)
    if not hit or not compound:
        raise ValueError(f"selector part not understood: {compound!r}")
    rest = hit["rest"]
    one = lambda pattern: (re.findall(pattern, rest) or [""])[0]
    return {
        "tag": "" if hit["tag"] in (None, "*") else hit["tag"],
        "id": one(r"#([\w-]+)"),
        "classes": tuple(re.findall(r"\.([\w-]+)", rest)),
        "part": one(r"\[class\*=([\w-]+)\]"),
        "nth": one(r":nth-child\((\d+)\)"),
        "typed": one(r":nth-of-type\((\d+)\)"),
    }


def _compounds(css: str) -> list[tuple[str, str]]:
    """(combinator, compound) pairs; the first combinator is a descendant one."""
    tokens = css.replace(">", " > ").split()
    pairs, link = [], " "
    for token in tokens:
        if token == ">":
            link = ">"
        else:
            pairs.append((link, token))
            link = " "
    return pairs


def _region(selector: str) -> tuple:
    css = _target(selector)[0]
    first = _parts(_compounds(css)[0][1])
    return first["tag"], first["id"], first["classes"], first["part"]


def _target(selector: str) -> tuple[str, bool, str | None]:
    """(css, strict descendants, attribute or None for text)."""
    hit = _TARGET.match(selector.strip())
    if not hit:
        return selector.strip(), False, None
    return hit["css"].strip(), bool(hit["deep"]), hit["attr"]


def _segment(p: dict) -> str:
    tag = re.escape(_encoded(p["tag"])) if p["tag"] else r"[^/\[]+"
    place = f"{p['nth'] or NUMBER},{p['typed'] or NUMBER}"
    ident = f"#{re.escape(_encoded(p['id']))}(?=\\.)" if p["id"] else r"(?:#[^/.]*)?"
    classes = "".join(rf"(?=[^/]*\.{re.escape(_encoded(c))}\.)" for c in p["classes"])
    part = rf"(?=[^/]*\.[^/.]*{re.escape(p['part'])})" if p["part"] else ""
    return rf"/{tag}\[{place}\]{ident}{classes}{part}[^/]*"


def path_regex(compound: str) -> str:
    """Regular expression for the steps that one part of a selector matches."""
    return f"^{_segment(_parts(compound))}$"


def html_values(html: Column, rule: str) -> Column:
    """Texts or attribute values that one rule matches on a page."""
    return html_fields(html, {"found": rule})["found"]


def _names_elements(selector: str) -> bool:
    return not _TARGET.match(selector.strip())


def _fits(nodes: Column, place: Column, css: str, deep: bool = False) -> Column:
    """Whether the element at a place matches (or lies strictly inside one that does).

    Ancestors are looked at from the inside out. Bit j of `open` says that the parts from j on are
    matched, so that part j - 1 is looked for: in the parent only if j is its child, else in any
    ancestor. No path is put together, so depth costs time in proportion and no memory."""
    links, parts = zip(*_compounds(css))
    regexes = [path_regex(p) for p in parts]
    links, last = [*links, " "], len(parts) - (not deep)
    element = F.get(nodes, place)
    own = F.lit(True) if deep else element["step"].rlike(regexes[-1])
    if last == 0:
        return own
    stays = sum(1 << j for j in range(1, last + 1) if links[j] == " ")
    # Where each part is a child of the one before, so many ancestors decide.
    steps = element["depth"] if stays else F.lit(last)

    def upward(so_far: Column, _: Column) -> Column:
        step, is_open = F.get(nodes, so_far["at"])["step"], so_far["open"]
        found = is_open.bitwiseAND(F.lit(stays))
        for j in range(1, last + 1):
            met = (is_open.bitwiseAND(F.lit(1 << j)) != 0) & step.rlike(regexes[j - 1])
            found = found.bitwiseOR(F.when(met, 1 << (j - 1)).otherwise(0))
        more = F.struct(_above(nodes, so_far["at"]).alias("at"), found.alias("open"))
        going_on = (so_far["at"] >= 0) & (is_open > 1) & (is_open.bitwiseAND(F.lit(1)) == 0)
        return F.when(going_on, more).otherwise(so_far)

    start = F.struct(_above(nodes, place).alias("at"), F.lit(1 << last).alias("open"))
    return own & (F.aggregate(F.sequence(F.lit(1), steps), start, upward)["open"].bitwiseAND(F.lit(1)) != 0)


def _above(nodes: Column, place: Column) -> Column:
    """Place of the parent element, -1 if it is not in the array."""
    up = F.get(nodes, place)["up"]
    return F.when(up > 0, place - up).otherwise(-1).cast("int")


def select_all(nodes: Column, selector: str) -> Column:
    """Every text or attribute value the selector matches, in document order."""
    css, deep, attr = _target(selector)

    def texts(nodes: Column) -> Column:
        hits = F.filter(nodes, lambda n, i: n["text"].isNotNull() & (n["up"] > 0) & _fits(nodes, i - n["up"], css, deep))
        return F.transform(hits, lambda n: n["text"])

    def values(nodes: Column) -> Column:
        value = lambda n: F.try_element_at(n["attrs"], F.lit(attr))
        return F.transform(F.filter(nodes, lambda n, i: value(n).isNotNull() & _fits(nodes, i, css, deep)), value)

    return lists.let(nodes, texts if attr is None else values)


def select_first(nodes: Column, selector: str) -> Column:
    return F.get(select_all(nodes, selector), F.lit(0))


def _elements(nodes: Column, css: str) -> Column:
    """elements() of an array that is a column or bound already."""
    return F.array_compact(F.transform(nodes, lambda n, i: F.when(n["text"].isNull() & _fits(nodes, i, css), i)))


def elements(nodes: Column, css: str) -> Column:
    """Places of the matching elements in the array."""
    return lists.let(nodes, lambda nodes: _elements(nodes, css))


def first_element(nodes: Column, css: str) -> Column:
    """The first matching element's node; null when there is none."""
    return lists.let(nodes, lambda nodes: F.get(nodes, F.get(_elements(nodes, css), F.lit(0))))


def within(nodes: Column, place: Column) -> Column:
    """The nodes of one element, as an array of its own. It comes first and has no step, so that
    selectors match inside it."""

    def cut(top: Column) -> Column:
        first = F.struct(F.lit("").alias("step"), *(top[c].alias(c) for c in ("text", "attrs", "up", "depth", "size")))
        return F.concat(F.array(first), F.slice(nodes, place + 2, top["size"] - 1))

    return lists.let(F.get(nodes, place), cut)


def first_within(nodes: Column, css: str) -> Column:
    """Nodes of the first matching element; null when there is none."""

    def inside(nodes: Column) -> Column:
        place = F.get(_elements(nodes, css), F.lit(0))
        return lists.let(place, lambda p: F.when(p.isNotNull(), within(nodes, p)))

    return lists.let(nodes, inside)


def within_first(nodes: Column, places: Column) -> Column:
    """Nodes of the first of the places; null when there is none."""
    return lists.let(F.get(places, F.lit(0)), lambda p: F.when(p.isNotNull(), within(nodes, p)))


def outside(nodes: Column, css: str) -> Column:
    """Nodes that lie in no matching element."""

    def rest(nodes: Column) -> Column:
        inside = lambda i: lambda p: (i >= p) & (i < p + F.get(nodes, p)["size"])
        return lists.let(_elements(nodes, css), lambda places: F.filter(nodes, lambda _, i: ~F.exists(places, inside(i))))

    return lists.let(nodes, rest)


def _shown(nodes: Column) -> Column:
    """Texts but those of scripts and styles."""
    hidden = lambda nodes, n, i: F.get(nodes, i - n["up"])["step"].rlike(_HIDDEN)
    seen = lambda nodes: lambda n, i: n["text"].isNotNull() & ~F.coalesce(hidden(nodes, n, i), F.lit(False))
    return lists.let(nodes, lambda nodes: F.transform(F.filter(nodes, seen(nodes)), lambda n: n["text"]))


def plain_text(nodes: Column) -> Column:
    """All text put together as it stands; script and style content is not text."""
    return F.array_join(_shown(nodes), "")


def element_texts(nodes: Column, css: str) -> Column:
    """Visible text of every matching element."""
    texts = lambda nodes: F.transform(_elements(nodes, css), lambda p: visible_text(within(nodes, p)))
    return lists.let(nodes, texts)


def visible_text(nodes: Column) -> Column:
    """Text a reader sees, near enough: script and style left out, runs of white space
    made one space, parts put together with a space. Styles are not evaluated."""
    parts = F.transform(_shown(nodes), lambda t: F.btrim(F.regexp_replace(t, r"[\s\xA0]+", " ")))
    return F.array_join(F.filter(parts, lambda x: x != ""), " ")


# --- page-wide shortcuts that need no node array ---------------------------------------

# Comments, scripts and styles are matched first and give an empty group, so markup
# quoted inside them is passed over.
_SKIP = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|"
# Attributes are passed over whole, quoted values with all they hold.
HREF_PATTERN = _SKIP + (
    r"""<a(?=\s)(?:\s+(?!href\s*=)[^\s=<>"']+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s<>"']+))?+)*+"""
    r"""\s+href\s*=\s*("[^"]*"|'[^']*'|[^\s<>]+)"""
)
# The five entities XML predefines.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def unescaped(text: Column) -> Column:
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def anchor_hrefs(html: Column) -> Column:
    """href of every anchor of the page, in document order, without leaving the JVM."""
    found = F.filter(F.regexp_extract_all(html, F.lit(HREF_PATTERN), F.lit(1)), lambda x: x != "")
    return F.transform(found, lambda x: unescaped(F.btrim(x, F.lit("\"'"))))


def element_text(html: Column, tag: str) -> Column:
    """Content of the first element of a kind that holds text only (title, h1)."""
    hits = F.filter(
        F.regexp_extract_all(html, F.lit(_SKIP + rf"<{tag}\b[^<>]*>([^<]*)</{tag}\s*>"), F.lit(1)),
        lambda x: x != "",
    )
    return unescaped(F.get(hits, F.lit(0)))
