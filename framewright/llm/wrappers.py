"""HTML extraction by wrappers: union-free regular expressions inferred from pages of one host.

A page's token stream (tags with their classes, text) becomes a tree. Inference works on sequences of siblings: two
streams are aligned; where they agree, their elements are aligned within; an element that one lacks becomes optional
``(E)?``; equal neighbours fold into ``(E)+``, and so do repeats of several elements, ``(E F)+``, and what lies beside
such a group and is in it; text that differs becomes a slot. A sequence that stays longer than WIDEST becomes one group
of optional elements, ``(E? F? G?)+``, which is still free of unions. So a wrapper is a sequence of elements, each with
its own sequence, an optional and a repeated mark and a slot; a slot knows how often it was filled and, by the least few
of their hashes, with how many different texts. Pages of a partition are folded into one wrapper for each host, then the
partitions' wrappers of a host into one. Elements are bounded in number: beyond MOST those that fewest pages have go.

The marks tell what the main text is. A slot that takes few texts beside what the host's best slots take (the same on
all pages, or one of some in turn) belongs to the template; the others hold what a page is about. The main text is in
the element that holds nearly all of their characters, descending while one child does, yet not past a varying heading;
within it a page's blocks are matched to the wrapper's elements, and those of the template are left out. An element
named for it (article, main) settles where the main text is and is then taken whole but for what its tags leave out.
Where marks can't tell, on pages that stand alone or for text that varies beside the main text as comments do, tags
(navigation, headers, footers, asides, scripts, controls) and the words of class and id leave out. Class words never
leave out html, body or main, nor, as long as no article is free of them, an article or what holds one. A form is left
out unless it holds an article or main, or all the text there is. A page without text at the wrapper's place is its own
wrapper; if that finds none either, only tags leave out.

Null, empty and tag-free html: the text there is, if any, is one block; hosts are taken from the url, null and odd urls
being one host ''. Repeated rows each give a row. Folding depends on the order of pages where their structure is odd, so
there a wrapper may differ with the files' splits; marks of what most pages have don't.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import operator
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Copies of each wrapper that its host's pages are dealt to.
SALTS = 32

#: How often a slot must be filled before its texts tell anything.
SEVERAL = 4
#: A slot is the template's if it takes fewer different texts for each time it is filled than this part of the best slots'.
FEW = 1 / 3
#: Hashes by which a slot's different texts are counted; estimates beyond.
KEPT = 16
#: Elements side by side that are told apart; repeats of several elements, at most; elements of a wrapper.
WIDEST, LONGEST, MOST = 64, 8, 4000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template svg math iframe".split())
SKIPPED = frozenset("head script style noscript template svg math iframe nav header footer aside form button select option textarea input label dialog menu title".split())
BLOCKS = frozenset("address article blockquote body br caption dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul footer aside form".split())
#: Opening one of these closes an open one of the set.
CLOSES = {"p": frozenset("p"), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"])}
HOLDERS = frozenset("ul ol dl table tbody body article section div main".split())
PHRASING = frozenset("a abbr b bdi bdo cite code em i kbd mark q s samp small span strong sub sup u var font label time br img".split())
BOILERPLATE = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|respond|cookies?|consent|copyright|disclaimer|footer|header|masthead|menu|nav\w*|newsletter|notices?|pagination|pager|popup|promo\w*|related|share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar|widgets?|login|search)(?:$|[-_\s\d])",
    re.I,
)
#: What such a word says of a page's layout, as in has-sidebar, is not what the element is.
MODIFIER = re.compile(r"(?:^|(?<=[-_\s]))(?:has|no|with|without)[-_]\S*", re.I)
MAIN = frozenset(["article", "main"])
#: Elements that may be anything, told apart by what they hold.
GENERIC = frozenset(["div", "section", "td"])
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
LISTS = frozenset("ul ol dl".split())
#: Never left out by the words of class and id.
WHOLE = frozenset(["html", "body", "main"])
#: How much class words leave out: by all of them; all but articles and what holds one; nothing. FORMS added: forms stay.
STRICT, HOLDING, TAGS, FORMS = 0, 1, 2, 4

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*(?:>|$)", re.S)
_TAG_START = re.compile(r"</?[a-zA-Z]")
_DELIMITER = re.compile(r"[>\"']")
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


class Node:
    __slots__ = ("tag", "names", "children", "shape")

    def __init__(self, tag: str, names: str = ""):
        self.tag, self.names, self.children, self.shape = tag, names, [], None


class _Ends:
    """Where tags end, for pages on which one doesn't: found once for all places, so that no search goes on to the end twice."""

    def __init__(self, page: str):
        self.at = [m.start() for m in _DELIMITER.finditer(page)]
        self.ends = [False] * (len(self.at) + 1)
        after: dict[str, int] = {}  # the delimiter's next place, by number
        for k in range(len(self.at) - 1, -1, -1):
            c = page[self.at[k]]
            self.ends[k] = c == ">" or (c in after and self.ends[after[c] + 1])
            if c != ">":
                after[c] = k

    def has(self, at: int) -> bool:
        """Whether a tag that begins here has an end."""
        return self.ends[bisect_left(self.at, at)]


class _Open:
    """The open elements, and by tag the places of those with it."""

    def __init__(self, root: Node):
        self.nodes, self.places, self.holders = [root], {}, [0]

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag in HOLDERS:
            self.holders.append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, at: int) -> None:
        for node in self.nodes[at:]:
            self.places[node.tag].pop()
            if node.tag in HOLDERS:
                self.holders.pop()
        del self.nodes[at:]

    def close(self, tag: str) -> None:
        if places := self.places.get(tag):
            self.cut(places[-1])

    def shut(self, tags: frozenset[str]) -> None:
        """Close what has one of the tags, down to the last element that holds such."""
        low = self.holders[-1]
        found = [places[k] for t in tags if (places := self.places.get(t)) and (k := bisect_right(places, low)) < len(places)]
        if found:
            self.cut(min(found))


def parse(page: str) -> Node:
    """The tree of a page's tokens; what is left open is closed where HTML closes it, or at the end."""
    root, at, looked = Node("#root"), 0, 0
    open_ = _Open(root)
    ends: _Ends | None = None

    def text(upto: int) -> None:
        if upto > at:
            open_.nodes[-1].children.append(page[at:upto])

    while (start := page.find("<", looked)) >= 0:
        looked = start + 1
        if ends is not None and _TAG_START.match(page, start) and not ends.has(start):
            continue
        m = _TOKEN.match(page, start)
        if not m:
            if ends is None and _TAG_START.match(page, start):
                ends = _Ends(page)
            continue
        text(start)
        at = looked = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            open_.close(tag)
            continue
        if (shut := CLOSES.get(tag)) or (tag in BLOCKS and tag != "br" and (shut := CLOSES["p"])):
            open_.shut(shut)
        if tag == "form" and open_.places.get(tag):
            continue  # forms aren't nested
        names = " ".join(next(filter(None, n[1:]), "") for n in _NAMED.findall(m[3])) if "=" in m[3] else ""
        node = Node(tag, names)
        open_.nodes[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            node.children.append(page[at : end.start() if end else len(page)])
            at = looked = end.end() if end else len(page)
        elif tag not in VOID and not m[3].rstrip().endswith("/"):
            open_.push(node)
    text(len(page))
    return root


def label(node: Node) -> str:
    """Tag and names, numbers made equal; of an element that may hold anything, also what kind of thing it holds."""
    names = re.sub(r"\d+", "9", node.names)
    said = f"{node.tag}.{names}" if names else node.tag
    if node.tag not in GENERIC:
        return said
    if node.shape is None:
        tags = {c.tag for c in _elements(node)}
        node.shape = "text" if tags & TEXTUAL else "parts" if tags & GENERIC or tags & MAIN else "list" if tags & LISTS else "leaf"
    return f"{said}#{node.shape}"


def worded(tag: str, names: str) -> bool:
    """Whether the words of class and id name an element as boilerplate."""
    return bool(names) and tag not in WHOLE and bool(BOILERPLATE.search(names)) and bool(BOILERPLATE.search(MODIFIER.sub("", names)))


def _holds(node: Node) -> bool:
    """Whether a node is named for the main text or one below it is."""
    open_ = [node]
    while open_:
        n = open_.pop()
        if n.tag in MAIN:
            return True
        if n.tag not in SKIPPED or n.tag == "form":
            open_ += [c for c in n.children if isinstance(c, Node)]
    return False


def _skipped(node: Node, level: int) -> bool:
    if node.tag == "form":
        return not level & FORMS and not _holds(node)
    return node.tag in SKIPPED or level & 3 < TAGS and worded(node.tag, node.names) and not (level & 3 == HOLDING and _holds(node))


# A wrapper's element: [label, optional, repeated, slot, size, elements, pages, seen, texts]; slot: None no text, a hash
# the only text, 1 several; size: characters of its own text over all pages; pages: those that have it; seen: how often its slot was filled; texts: the least KEPT of the hashes of
# its different texts. A group of several elements has the label GROUP. A wrapper: [pages, element of the root].
LABEL, OPTIONAL, REPEATED, SLOT, SIZE, INNER, PAGES, SEEN, TEXTS = range(9)
GROUP = "()"


def _own_text(node: Node) -> str:
    return " ".join("".join(c for c in node.children if isinstance(c, str)).split())


def _hashed(block: str) -> int:
    """A hash of a block's whole text, of 52 bits."""
    return int.from_bytes(hashlib.blake2b(block.encode("utf-8", "surrogatepass"), digest_size=8).digest()) >> 12


def _generalise(node: Node) -> list:
    # By steps, not by calls, here and below: pages may be nested however deep. First down, then back up.
    order = [node]
    for n in order:
        order += [c for c in n.children if isinstance(c, Node)]
    done: dict[int, tuple[list, list[str]]] = {}
    for n in reversed(order):
        own, inner = [] if n.tag in RAW else [_own_text(n)], []
        for c in n.children:
            if isinstance(c, Node):
                e, text = done.pop(id(c))
                if c.tag in PHRASING:
                    own += text
                    inner += e[INNER]
                else:
                    inner.append(e)
        said, texts = "", []
        if n.tag not in PHRASING:
            said = " ".join(filter(None, own))
            texts = [_hashed(t)] if (t := " ".join(entities.unescape(said).split())) else []
        done[id(n)] = [label(n), False, False, _slot(texts), len(said), inner if n.tag in PHRASING else _tighten(inner, max), 1, len(texts), texts], own
    return done[id(node)][0]


def _slot(texts: list[int]) -> str | int | None:
    return 1 if len(texts) > 1 else f"{texts[0]:x}" if texts else None


Pages = Callable[[int, int], int]


def _met(a: list, b: list, pages: Pages) -> list:
    """Two elements as one, without the elements in them."""
    texts = a[TEXTS] if a[TEXTS] == b[TEXTS] else sorted({*a[TEXTS], *b[TEXTS]})[:KEPT]
    return [a[LABEL], a[OPTIONAL] or b[OPTIONAL], a[REPEATED] or b[REPEATED], _slot(texts), a[SIZE] + b[SIZE], [], pages(a[PAGES], b[PAGES]), a[SEEN] + b[SEEN], texts]


def _merge(a: list, b: list, pages: Pages = operator.add) -> list:
    """pages: how numbers of pages meet; those of neighbours on one page don't add up."""
    out = _met(a, b, pages)
    open_ = [(out, a[INNER], b[INNER])]
    while open_:
        e, x, y = open_.pop()
        aligned, below = align(x, y, pages)
        # Within first: what folds takes whole elements.
        for met, p, q in below:
            open_.append((met, p, q))
        e[INNER] = aligned
    return out


def _labels(e: list) -> set[str]:
    return {x[LABEL] for x in e[INNER]}


def _folded(a: list, b: list, pages: Pages) -> list:
    """Two that stand side by side as one: optional only if both are."""
    out = _merge(a, b, pages)
    out[OPTIONAL] = a[OPTIONAL] and b[OPTIONAL]
    return out


def _into(group: list, elements: list, pages: Pages, meet: Callable[[list, list, Pages], list] = _folded) -> None:
    """Elements into a group: those it has meet. If the elements are another page's, what only one side has is optional."""
    at = {x[LABEL]: k for k, x in enumerate(group[INNER])}
    given = set()
    for e in elements:
        given.add(e[LABEL])
        if e[LABEL] in at:
            k = at[e[LABEL]]
            group[INNER][k] = meet(group[INNER][k], e, pages)
        else:
            at[e[LABEL]] = len(group[INNER])
            group[INNER].append([e[LABEL], True, *e[2:]])
    if meet is _merge:
        group[INNER] = [x if x[LABEL] in given else [x[LABEL], True, *x[2:]] for x in group[INNER]]
    group[PAGES] = max(x[PAGES] for x in group[INNER])


def _grouped(elements: list) -> list:
    return [GROUP, False, True, None, 0, elements, max(e[PAGES] for e in elements), 0, []]


def _tighten(elements: list, pages: Pages) -> list:
    """The sequence with equal neighbours, repeats of several elements and what belongs to a group beside it folded."""
    out: list = []
    for e in elements:
        if e[LABEL] == GROUP:
            inner = _labels(e)
            while out and (out[-1][LABEL] in inner or out[-1][LABEL] == GROUP and _labels(out[-1]) & inner):
                last = out.pop()
                e = [GROUP, e[OPTIONAL] and last[OPTIONAL], *e[2:INNER], list(e[INNER]), *e[PAGES:]]
                _into(e, last[INNER] if last[LABEL] == GROUP else [last], pages)
            out.append(e)
            continue
        if out and out[-1][LABEL] == e[LABEL]:
            out[-1] = _folded(out[-1], e, pages)
            out[-1][REPEATED] = True
        elif out and out[-1][LABEL] == GROUP and e[LABEL] in _labels(out[-1]):
            out[-1] = [*out[-1][:INNER], list(out[-1][INNER]), *out[-1][PAGES:]]
            _into(out[-1], [e], pages)
        else:
            out.append(e)
        for n in range(2, min(LONGEST, len(out) // 2) + 1):
            if out[-1][LABEL] != out[-1 - n][LABEL]:
                continue
            again, before = out[-n:], out[-2 * n : -n]
            if [x[LABEL] for x in again] == [x[LABEL] for x in before] and not any(x[LABEL] == GROUP for x in again):
                out[-2 * n :] = [_grouped([_folded(x, y, pages) for x, y in zip(before, again)])]
                break
    if len(out) > WIDEST:
        group = [GROUP, False, True, None, 0, [], 0, 0, []]
        for e in out:
            _into(group, e[INNER] if e[LABEL] == GROUP else [e], pages)
        if len(group[INNER]) > WIDEST:  # too many names: told apart by their tags only
            plain: dict[str, list] = {}
            for e in group[INNER]:
                tag = _split(e[LABEL])[0]
                plain[tag] = _merge(plain[tag], [tag, *e[1:]], pages) if tag in plain else [tag, *e[1:]]
            group[INNER] = list(plain.values())
        group[INNER] = [[x[LABEL], True, *x[2:]] for x in group[INNER]]
        out = [group]
    return out


def _key(e: list) -> str:
    return e[LABEL] if e[LABEL] != GROUP else GROUP + e[INNER][0][LABEL]


def _wrapped(elements: list, other: list, pages: Pages) -> list:
    """The sequence with runs that the other one has as a group made such a group, once round."""
    groups = [(e[INNER][0][LABEL], _labels(e)) for e in other if e[LABEL] == GROUP]
    if not groups:
        return elements
    plain = {e[LABEL] for e in other}
    out, k = [], 0
    while k < len(elements):
        for first, labels in groups:
            upto = k
            while upto < len(elements) and elements[upto][LABEL] in labels:
                upto += 1
            run = elements[k:upto]
            if len(mine := {e[LABEL] for e in run}) > 1 or run and not mine & plain:
                group = [GROUP, all(e[OPTIONAL] for e in run), True, None, 0, [], 0, 0, []]
                # The group's first label stands first here too, for groups meet by it.
                if first not in mine:
                    group[INNER].append([first, True, False, None, 0, [], 0, 0, []])
                for e in sorted(run, key=lambda e: e[LABEL] != first):
                    _into(group, [e], pages)
                    if not e[OPTIONAL]:
                        group[INNER] = [[x[LABEL], x[OPTIONAL] and x[LABEL] != e[LABEL], *x[2:]] for x in group[INNER]]
                out.append(group)
                k = upto
                break
        else:
            out.append(elements[k])
            k += 1
    return out


def align(a: list, b: list, pages: Pages = operator.add) -> tuple[list, list]:
    """The least sequence of elements that matches both: common subsequence, the rest optional, folded.

    Also the elements that met, each with the two sequences that are to be aligned within it.
    """
    a, b = _wrapped(a, b, pages), _wrapped(b, a, pages)
    x, y = [_key(e) for e in a], [_key(e) for e in b]
    if x == y and GROUP not in {e[LABEL] for e in a}:
        out = [_met(p, q, pages) for p, q in zip(a, b)]
        return out, [(e, p[INNER], q[INNER]) for e, p, q in zip(out, a, b)]
    head = 0
    while head < min(len(x), len(y)) and x[head] == y[head]:
        head += 1
    tail = 0
    while tail < min(len(x), len(y)) - head and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    n, m = len(x) - head - tail, len(y) - head - tail
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if x[head + i] == y[head + j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j, alone = [], 0, 0, False
    while i < len(a) or j < len(b):
        inside = head <= i < head + n or head <= j < head + m
        if i < len(a) and j < len(b) and x[i] == y[j] and (not inside or (i < head + n and j < head + m)):
            out.append(_both(a[i], b[j], pages))
            i, j = i + 1, j + 1
        elif j >= head + m or i < head + n and best[i + 1 - head][j - head] >= best[i - head][j + 1 - head]:
            out.append([a[i][LABEL], True, *a[i][2:]])
            alone = True
            i += 1
        else:
            out.append([b[j][LABEL], True, *b[j][2:]])
            alone = True
            j += 1
    return (_tighten(out, pages) if alone else out), []


def _both(a: list, b: list, pages: Pages) -> list:
    if a[LABEL] != GROUP:
        return _merge(a, b, pages)
    out = [GROUP, a[OPTIONAL] or b[OPTIONAL], True, None, 0, list(a[INNER]), 0, 0, []]
    _into(out, b[INNER], pages, _merge)
    return out


def infer(pages: Iterator[str]) -> list:
    """[pages, wrapper]"""
    out = None
    for page in pages:
        one = [1, _generalise(parse(page))]
        out = one if out is None else combine(out, one)
    return out


def combine(a: list, b: list) -> list:
    return _bounded([a[0] + b[0], _merge(a[1], b[1])])


def _bounded(wrapper: list) -> list:
    """The wrapper without what fewest pages have, if it has more than MOST elements."""
    order = [wrapper[1]]
    for e in order:
        order += e[INNER]
    if len(order) <= MOST:
        return wrapper
    # A child isn't on more pages than what holds it, but groups count loosely: keep a child only with its parent.
    least = sorted((e[PAGES] for e in order), reverse=True)[MOST // 2]
    open_ = [wrapper[1]]
    while open_:
        e = open_.pop()
        e[INNER] = [x for x in e[INNER] if x[PAGES] > least]
        open_ += e[INNER]
    return wrapper


def _split(name: str) -> tuple[str, str]:
    tag, _, names = name.partition("#")[0].partition(".")
    return tag, names


def dump(wrapper: list) -> str:
    """A wrapper as JSON: its elements in page order, each with the number of those in it."""
    flat, open_ = [], [wrapper[1]]
    while open_:
        e = open_.pop()
        flat.append([*e[:INNER], len(e[INNER]), *e[INNER + 1 :]])
        open_ += reversed(e[INNER])
    return json.dumps([wrapper[0], flat])


def load(said: str) -> list:
    pages, flat = json.loads(said)
    above: list[tuple[list, int]] = []
    for e in flat:
        holds, e[INNER] = e[INNER], []
        while above and len(above[-1][0][INNER]) == above[-1][1]:
            above.pop()
        if above:
            above[-1][0][INNER].append(e)
        above.append((e, holds))
    return [pages, flat[0]]


def _has_main(e: list) -> bool:
    open_ = [e]
    while open_:
        e = open_.pop()
        tag = _split(e[LABEL])[0]
        if tag in MAIN:
            return True
        if tag not in SKIPPED or tag == "form":
            open_ += e[INNER]
    return False


def _out(e: list, level: int) -> bool:
    tag, names = _split(e[LABEL])
    if tag == "form":
        return not level & FORMS and not _has_main(e)
    return tag in SKIPPED or level & 3 < TAGS and worded(tag, names) and not (level & 3 == HOLDING and _has_main(e))


def _different(texts: list[int], seen: int) -> float:
    """How many different texts there are for each time one was seen."""
    distinct = len(texts) if len(texts) < KEPT else (KEPT - 1) / ((texts[-1] + 1) / (1 << 52))
    return min(1.0, distinct / seen)


def template(wrapper: list) -> set[int]:
    """The elements, by identity, whose slots take few texts beside what the host's best slots take.

    Elements of one label in one element are judged together, for an advert may stand in several places.
    """
    told: list[tuple[float, int, list]] = []
    order = [wrapper[1]]
    for e in order:
        alike: dict[str, list] = {}
        for x in _flat(e[INNER]):
            order.append(x)
            if x[SEEN]:
                alike.setdefault(x[LABEL], []).append(x)
        for all_ in alike.values():
            seen = sum(x[SEEN] for x in all_)
            if seen >= SEVERAL:
                texts = sorted({t for x in all_ for t in x[TEXTS]})[:KEPT]
                told.append((_different(texts, seen), sum(x[SIZE] for x in all_), all_))
    whole = sum(size for _, size, _ in told)
    best = max((d for d, size, _ in told if 20 * size >= whole), default=1.0)
    return {id(x) for d, _, all_ in told if d <= FEW * best for x in all_}


def _masses(wrapper: list, level: int, constant: set[int]) -> dict[int, int]:
    """Characters of each element with those in it, by its identity; 0 for what is left out, the template's uncounted."""
    order, left = [wrapper[1]], set()
    for e in order:
        if _out(e, level):
            left.add(id(e))
        else:
            order += e[INNER]
    mass: dict[int, int] = {}
    for e in reversed(order):
        mass[id(e)] = 0 if id(e) in left else (0 if id(e) in constant else e[SIZE]) + sum(mass[id(x)] for x in e[INNER])
    return mass


def _named(wrapper: list, level: int) -> tuple[list[tuple[int, int, str]], list[str]]:
    """(characters, depth, tag) of the elements with text that are named for the main text; the path to the first of the largest."""
    mass = _masses(wrapper, level, set())
    found: list[tuple[int, int, str]] = []
    path: list[str] = []
    best: list[str] = []
    most = (0, 0)
    open_ = [(wrapper[1], 1)]
    while open_:
        e, depth = open_.pop()
        if _out(e, level):
            continue
        del path[depth - 1 :]
        path.append(e[LABEL])
        if (tag := _split(e[LABEL])[0]) in MAIN and mass[id(e)]:
            found.append((mass[id(e)], depth, tag))
            if found[-1][:2] > most:
                most, best = found[-1][:2], path[:]
        open_ += [(x, depth + 1) for x in reversed(e[INNER])]
    return found, [p for p in best if p != GROUP]


def _heads(e: list, mass: dict[int, int]) -> bool:
    """Whether an element is, or holds, a heading with text that counts."""
    open_ = [e]
    while open_:
        e = open_.pop()
        if mass.get(id(e), 0):
            if _split(e[LABEL])[0] in ("h1", "h2", "h3"):
                return True
            open_ += e[INNER]
    return False


def main_path(wrapper: list, level: int | None = None) -> tuple[list[str], bool, int]:
    """(labels down to the element with the main text, whether it is named for it, what class words leave out)."""
    if level is None:
        # An article that no class word hides makes others comments and the like; without one, none is left out.
        level, strict, holding = STRICT, _named(wrapper, STRICT)[0], _named(wrapper, HOLDING)[0]
        if not any(tag == "article" for *_, tag in strict) and 2 * max(strict, default=(0,))[0] < max(holding, default=(0,))[0]:
            level = HOLDING
    if best := _named(wrapper, level)[1]:
        return best, True, level
    mass = _masses(wrapper, level, set())
    if not mass[id(wrapper[1])]:
        level |= FORMS
    constant = template(wrapper)
    mass = _masses(wrapper, level, constant)
    if not mass[id(wrapper[1])]:
        mass = _masses(wrapper, level, set())
    e, path = wrapper[1], [wrapper[1][LABEL]]
    while e[INNER]:
        below = max(e[INNER], key=lambda x: mass.get(id(x), 0))
        here = mass.get(id(below), 0)
        if here <= 0.6 * mass[id(e)] or below[LABEL] != GROUP and (not below[INNER] or _split(below[LABEL])[0] in ("p", "li", "ul", "ol", "table", "blockquote", "pre")):
            break
        if below[LABEL] == GROUP or any(x is not below and _heads(x, mass) for x in e[INNER]):
            break
        e = below
        path.append(e[LABEL])
    return path, False, level


def _find(root: Node, path: list[str]) -> list[Node]:
    here = [root]
    for name in path[1:]:
        here = [c for n in here for c in _elements(n) if label(c) == name]
    return here


def _elements(node: Node) -> Iterator[Node]:
    """The elements in a node, those in phrasing ones in their place."""
    open_ = [iter(node.children)]
    while open_:
        c = next(open_[-1], None)
        if c is None:
            open_.pop()
        elif isinstance(c, Node):
            if c.tag in PHRASING:
                open_.append(iter(c.children))
            else:
                yield c


def _at(wrapper: list, path: list[str]) -> list | None:
    """The wrapper's element at a path of labels; groups have no label in it."""
    here = [wrapper[1]]
    for name in path[1:]:
        here = [x for e in here for x in _flat(e[INNER]) if x[LABEL] == name]
    return here[0] if here else None


def _flat(elements: list) -> Iterator[list]:
    for e in elements:
        if e[LABEL] == GROUP:
            yield from e[INNER]
        else:
            yield e


class _Match:
    """Goes through a wrapper's sequence as a page's elements come by, and says which element each one is."""

    __slots__ = ("elements", "at", "by_group")

    def __init__(self, element: list | None):
        self.elements, self.at = element[INNER] if element else [], 0

    def next(self, node: Node) -> list | None:
        for name in {label(node): 0, node.tag: 1}:
            # From where the last one was, for it may be repeated; else from the start, for groups fold what lay apart.
            for places in (range(self.at, len(self.elements)), range(self.at)):
                for k in places:
                    e = self.elements[k]
                    if e[LABEL] == name:
                        self.at = k
                        return e
                    if e[LABEL] == GROUP:
                        for x in e[INNER]:
                            if x[LABEL] == name:
                                self.at = k
                                return x
        return None


def blocks(node: Node, level: int = STRICT, element: list | None = None, constant: set[int] = frozenset()) -> list[str]:
    """Texts of the blocks under a node, references decoded, white space made one blank.

    element: the wrapper's element that the node is; constant: of its elements, those whose own text is left out.
    """
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        if t := " ".join(entities.unescape("".join(held)).split()):
            out.append(t)
        held.clear()

    # (children to come, whether a block ends with them, the elements they are among, whether text in them counts)
    stack: list = [(iter(node.children), True, _Match(element), id(element) not in constant)]
    while stack:
        children, ends, match, counts = stack[-1]
        c = next(children, None)
        if c is None:
            stack.pop()
            if ends:
                flush()
        elif isinstance(c, str):
            if counts:
                held.append(c)
        elif c.tag in PHRASING:
            if c.tag in BLOCKS:
                flush()
            if not _skipped(c, level):
                stack.append((iter(c.children), c.tag in BLOCKS, match, counts))
        else:
            e = match.next(c) if constant else None
            if not _skipped(c, level):
                if block := c.tag in BLOCKS:
                    flush()
                stack.append((iter(c.children), block, _Match(e) if constant else match, id(e) not in constant))
    return out


def plan_of(wrapper: list) -> tuple:
    """What extraction needs of a wrapper: the path to the main text, whether it is named, the level, its element and what is the template's."""
    path, named, level = main_path(wrapper)
    element = None if named else _at(wrapper, path)
    return path, named, level, element, frozenset() if element is None else frozenset(template(wrapper))


def extract(page: str, wrapper: list | None, plan: tuple | None = None) -> str:
    root = parse(page)
    path, _, level, element, constant = plan or plan_of(wrapper or [1, _generalise(root)])
    places = _find(root, path)
    found = [b for n in places for b in blocks(n, level, element, constant)]
    if not found and constant:
        found = [b for n in places for b in blocks(n, level)]
    own = None if found else [1, _generalise(root)]
    for again in (None, TAGS, TAGS | FORMS):
        if not found:
            path, _, level = main_path(own, again)
            found = [b for n in _find(root, path) for b in blocks(n, level)]
    return "\n".join(found)


def host_of(url):
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) with the wrapper as JSON; pages: host, html."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list] = {}
        for rb in common.slices(batches, "html"):
            for host, page in zip(rb.column("host").to_pylist(), rb.column("html").to_pylist()):
                one = [1, _generalise(parse(page))]
                known[host] = combine(known[host], one) if host in known else one
            if len(known) > 20_000:  # a partition of very many hosts sends some of them in parts
                yield pa.RecordBatch.from_arrays([pa.array(known), pa.array(map(dump, known.values()))], ["host", "wrapper"])
                known = {}
        yield pa.RecordBatch.from_arrays([pa.array(known, pa.string()), pa.array(map(dump, known.values()), pa.string())], ["host", "wrapper"])

    def meet(table: pa.Table) -> pa.Table:
        out = None
        for w in map(load, sorted(table.column("wrapper").to_pylist())):
            out = w if out is None else combine(out, w)
        return pa.table({"host": [table.column("host")[0].as_py()], "wrapper": [dump(out)]})

    schema = "host string, wrapper string"
    return pages.select("host", "html").mapInArrow(fold, schema).groupBy("host").applyInArrow(meet, schema)


def extract_main(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    pages = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"), host_of(F.col(url_col)).alias("host"))
    wrappers = common.stage_table(infer_wrappers(pages), "wrappers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans: dict[str, tuple] = {}
        for rb in common.slices(batches, "html"):
            texts = []
            for page, said in zip(rb.column("html").to_pylist(), rb.column("wrapper").to_pylist()):
                if said not in plans:
                    if len(plans) > 1000:
                        plans.clear()
                    plans[said] = plan_of(load(said))
                texts.append(extract(page, None, plans[said]))
            yield pa.RecordBatch.from_arrays([rb.column("page_id"), rb.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    salted = wrappers.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = pages.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, ["host", "salt"]).select("page_id", "url", "html", "wrapper").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main(spark.read.parquet(f"{sf_dir}/pages.parquet"))
