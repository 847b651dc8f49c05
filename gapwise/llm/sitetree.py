"""Main text of web pages by a site style tree.

All pages of a host are merged into one tree. A node of that tree is a path of
style keys (tag, class and id words without digits), so nodes that look alike
fall together. For a node that ``m`` pages have:

* presentation importance: the entropy, to base m, of the child sequences that
  the node has in those pages (0: every page lays it out alike);
* content importance: 1 minus the mean, over the distinct texts in the node, of
  log_m of the number of pages with that text (0: every page has the same text).

A branch of which both fall below ``THRESHOLD`` is template noise and is removed
from each page of the host, if at least ``MIN_PAGES`` pages have it. Pages of a
host whose own text (what no tag, role or word marks) is the same count as one,
so the copies of an article do not look like template. The tree is
only ever held as counts (host, node, feature, pages): tasks count their own
pages first, sums are then shuffled, so a host with a third of all pages is no
burden on a single task.

Entropy cannot tell menus and adverts that change from page to page, nor judge
hosts with few pages. So a node's tag, role, class and id words also mark
branches as noise (``NOISE_TAGS``, ``NOISE_WORDS``), and a page keeps only what lies in
its ``main`` (else its articles) if that is at least half of the text that is
neither marked, nor links, nor template. Entropy never removes what lies in
an article chosen so, nor the plain text elements (whatever their class) of a
``main``, nor a page's whole text.

Text inside a block element forms a block: character references decoded, white
space turned into single blanks, trimmed; blocks are joined by two line breaks.

A class or id word is weaker evidence than a tag or role. Inside an article or
``main`` it counts only in a name made of nothing else than words for adverts,
comments and the like and words for places (``STRONG_WORDS``, ``PLACE_WORDS``), or if
entropy agrees: ``related-work`` and ``notice`` stay. Elsewhere it takes no branch
that holds the ``main`` element, the page's only articles, or more than half of
the text that the host's entropy leaves (nine tenths beside an article or
``main`` that no word marks); nor branches named by a class that together hold
that much (``elementor-widget``). Where words leave nothing, they
are not regarded. A ``form`` counts as such a word (it may enclose a page).

Outside articles, text that is nearly all link goes where ``LINK_RUN`` such blocks
follow each other, as in a menu; a title or paragraph that is a link stays. A
page's only ``h1`` belongs to the article or ``main`` that follows it. A section
that begins with a heading such as "12 Responses" holds reader comments.

Parsing takes time in proportion to the page, however deep its elements are.

Edge cases: null or empty html gives an empty text; unclosed, wrongly nested
and unknown tags, an unclosed comment or script never fail; a null url or one
without a host belongs to no site; repeated rows get equal results; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapwise.llm.arrowtext import ascii_lower, map_arrow
from gapwise.session import checkpoint_root

THRESHOLD = 0.2
MIN_PAGES = 5
#: Noise paths in all that are broadcast; beyond that pages and paths are joined by host.
BROADCAST_PATHS = 200_000
SALTS = 32

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Words of a class or id value; capitals inside begin a new word.
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup; it ends at their own end tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "html head body address article aside blockquote center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search "
    "section summary table tbody td tfoot th thead tr caption ul option select template noscript".split())
#: Start tags that end an open element of these tags, not looking beyond the second set.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}
_IN_HEAD = frozenset("base link meta title style script noscript template".split())
_BARE = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt td th blockquote pre figcaption article main".split())

NOISE_TAGS = frozenset(
    "head nav footer aside script style noscript template iframe object svg canvas button select "
    "textarea dialog menu title search datalist fieldset audio video map".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog "
                        "menu menubar toolbar tablist".split())
#: Words of class and id values.
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot adunit adbanner adspace sponsor sponsored sponsors promo promotion "
    "banner cookie cookies consent gdpr notice notices notification alert popup modal overlay lightbox "
    "newsletter subscribe subscription signup login sidebar menu nav navbar navigation navigate breadcrumb "
    "breadcrumbs topbar masthead footer comment comments commentlist disqus respond reply replies share "
    "sharing social related recommended recommendations widget widgets toolbar pagination pager copyright "
    "skip hidden".split())
#: Words that speak for noise in an article too, in names of these and ``PLACE_WORDS`` alone.
STRONG_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot adunit adbanner adspace sponsor sponsored "
    "sponsors cookie cookies consent gdpr newsletter comment comments commentlist disqus breadcrumb breadcrumbs share "
    "sharing signup sidebar".split())
PLACE_WORDS = frozenset("top bottom left right box block list section area wrap wrapper container inner outer button "
                        "buttons bar form user reader site page notice inline link links item items".split())
#: How a section of reader comments is headed.
COMMENT_HEADING = re.compile(
    r"(?:\d+ )?(?:reader |user )?(?:comments?|responses?|replies|kommentare?|antworten|commentaires?|réponses?|"
    r"comentarios?|respuestas?)(?: \(?\d+\)?)?:?", re.I)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: So many blocks of links one after the other are a menu.
LINK_RUN = 3
#: Parts of words that say the same wherever they stand.
NOISE_PARTS = re.compile("comment|cookie|sidebar|advert|newsletter|breadcrumb|sponsor|popup")
#: With one of these words beside it, a word like ``header`` names a part of the article.
ARTICLE_WORDS = frozenset("article post entry story content main body text".split())


class _Open:
    """An open element; ``block`` is the block element that its text belongs to."""
    __slots__ = ("tag", "path", "noise", "article", "main", "bare", "children", "link", "mark", "depth", "block", "since")

    def __init__(self, tag, path, noise, article, main, bare, link, mark, depth=0, around=None, since=0):
        self.tag, self.path, self.noise, self.article, self.main = tag, path, noise, article, main
        self.bare, self.link, self.mark = bare, link, mark
        self.depth, self.since = depth, since
        self.block = self if around is None or tag in BLOCK else around.block
        self.children: list[str] = []


class Mark:
    """An element whose class or id words name noise; ``up`` is the next one around it.

    ``inside``: it lies in an article or main; ``strong``: a name says so there too.
    """
    __slots__ = ("up", "number", "names", "main", "article", "inside", "strong")

    def __init__(self, up: Mark | None, number: int, names: tuple[str, ...], inside: bool):
        self.up, self.number, self.names, self.inside = up, number, names, inside
        self.strong = any(map(_strong, names))
        self.main = self.article = False


def _strong(name: str) -> bool:
    words = {w.lower() for w in _WORDS.findall(name)}
    return name == "<form>" or bool(words & STRONG_WORDS) and words <= STRONG_WORDS | PLACE_WORDS


_paths: dict[tuple[int, str], int] = {}


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(),
                          "little", signed=True)


def _path(parent: int, key: str) -> int:
    at = (parent, key)
    if at not in _paths:
        if len(_paths) > 100_000:
            _paths.clear()
        _paths[at] = _hash(f"{parent}/{key}")
    return _paths[at]


def _marks(tag: str, names: list[str], words: set[str]) -> tuple[str, ...]:
    """The class and id names that speak for noise."""
    def speaks(name: str) -> bool:
        own = {w.lower() for w in _WORDS.findall(name)}
        if tag == "article":
            return bool(own & {"reply", "comment"})
        return (bool(own & NOISE_WORDS) or any(NOISE_PARTS.search(w) for w in own)
                or "header" in own and not words & ARTICLE_WORDS)

    return tuple(n for n in names if speaks(n))


def _style(tag: str, raw: str) -> tuple[str, bool, bool, bool, tuple[str, ...]]:
    """Style key of an element, whether it is noise, the main content, the article, and its noise names."""
    noise, article, main = tag in NOISE_TAGS, tag == "article", tag == "main"
    marks = ("<form>",) if tag == "form" else ()
    if not raw or raw.isspace():
        return tag, noise, main, article, marks
    found = {}
    for m in _ATTRIBUTE.finditer(raw):
        found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    names = [n for a in ("class", "id") for n in found.get(a, "").split()]
    words = {w.lower() for n in names for w in _WORDS.findall(n)}
    key = ".".join([tag, *sorted(words)])
    role = found.get("role", "").lower()
    if tag not in ("html", "body", "main"):
        noise |= role in NOISE_ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true"
        noise |= "display:none" in found.get("style", "").replace(" ", "").lower()
        if words:
            marks += _marks(tag, names, words)
    main |= role == "main"
    article |= role == "article" or "articlebody" in found.get("itemprop", "").lower()
    return key, noise, main, article, marks


class Block:
    __slots__ = ("tag", "path", "text", "noise", "article", "main", "bare", "links", "mark")

    def __init__(self, at: _Open, text: str, links: int):
        self.tag, self.path, self.text, self.noise, self.mark = at.tag, at.path, text, at.noise, at.mark
        self.article, self.main, self.bare, self.links = at.article, at.main, at.bare, links


def parse(html: str) -> tuple[list[Block], list[tuple[int, int]]]:
    """The text blocks of a page in page order, and (path, child sequence) of its elements."""
    root = _Open("", 0, False, False, False, False, False, None)
    stack, blocks, layouts, parts = [root], [], [], []
    at_depth: dict[str, list[int]] = defaultdict(list)  # where the open elements of a tag are, outermost first
    beside: list[tuple[str, Mark]] = []
    links, pos, size, marked = 0, 0, len(html), 0

    def flush() -> None:
        nonlocal links
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            parts.clear()
            if text:
                at = stack[-1].block
                if at.tag in HEADINGS and COMMENT_HEADING.fullmatch(text):
                    around = stack[at.depth - 1].block
                    if around.tag in ("section", "div", "ol", "ul") and around.since == len(blocks):
                        around.noise = at.noise = True
                blocks.append(Block(at, text, links))
            links = 0
        if beside:
            text = " ".join(unescape("".join(x for x, _ in beside)).split())
            if text:
                at = stack[-1].block
                b = Block(at, text, 0)
                b.path, b.mark = _path(at.path, "~"), beside[-1][1]
                blocks.append(b)
            beside.clear()

    def close(depth: int) -> None:
        while len(stack) > depth:
            e = stack.pop()
            at_depth[e.tag].pop()
            if e.children:
                layouts.append((e.path, _hash(" ".join(e.children))))

    def last(tag: str) -> int:
        return at_depth[tag][-1] if at_depth[tag] else 0

    def say(text: str) -> None:
        nonlocal links
        top = stack[-1]
        if not text or top.tag in ("html", "head", "") and text.isspace():
            return
        owner = top.block
        if top.noise and not owner.noise:
            return  # an advert or button inside a line of text
        if top.mark is not owner.mark:
            beside.append((text, top.mark))
            return
        parts.append(text)
        if top.link:
            links += len(text)

    while pos < size:
        m = _TAG.search(html, pos)
        if m is None:
            say(html[pos:])
            break
        say(html[pos:m.start()])
        pos = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag, raw = name.lower(), m[3] if m[2] else m[6]
        block = tag in BLOCK
        if m[1] or m[4]:
            depth = last(tag)
            if block:
                flush()
            if depth:
                if not block and stack[-1].block.depth > depth:
                    continue  # an inline end tag does not close blocks
                close(depth)
            continue
        if block:
            flush()
            if stack[-1].tag == "head" and tag not in _IN_HEAD:
                close(len(stack) - 1)
            depth = last("p")
            if depth and stack[-1].block.depth <= depth:
                close(depth)
            if tag in ENDS:
                ends, stop = ENDS[tag]
                limit = max(last(t) for t in stop)
                open_ends = [at_depth[t][k] for t in ends if (k := bisect_right(at_depth[t], limit)) < len(at_depth[t])]
                if open_ends:
                    close(min(open_ends))
        elif tag == "br":
            parts.append(" ") if parts else None
        top = stack[-1]
        key, noise, main, article, names = _style(tag, raw)
        if tag == "header" and not (top.article or top.main):
            noise = True
        if not top.children or top.children[-1] != key:
            top.children.append(key)
        if tag in VOID or tag in RAW or raw.endswith("/") and tag in ("svg", "path", "use"):
            if tag in RAW:
                end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>", re.I).search(html, pos)
                pos = end.end() if end else size
            continue
        mark = top.mark
        if names:
            mark, marked = Mark(mark, marked, names, top.article or top.main), marked + 1
        if mark is not None:
            mark.main |= main
            mark.article |= article
        at_depth[tag].append(len(stack))
        stack.append(_Open(tag, _path(top.path, key) if block else top.path, top.noise or noise,
                           top.article or article, top.main or main, tag in _BARE, top.link or tag == "a",
                           mark, len(stack), top, len(blocks)))
    flush()
    close(1)
    return blocks, layouts


def _weight(text: str) -> int:
    """Words of a text, or their number by its length where blanks do not part words."""
    return max(text.count(" ") + 1, len(text) // 8)


def _weights(blocks: list[Block], noise: frozenset[int] | set[int]) -> list[int]:
    """How much each block says for the place of the main text: links and template text nothing."""
    plain = [0 if b.links >= 0.8 * len(b.text) else _weight(b.text) for b in blocks]
    own = [0 if b.path in noise else n for b, n in zip(blocks, plain)]
    return own if any(own) else plain


def _unmarked(blocks: list[Block], noise: frozenset[int] | set[int]) -> list[Block]:
    """The blocks that no class or id word takes."""
    if all(b.mark is None for b in blocks):
        return blocks
    held: dict[Mark, int] = {}
    total = 0
    for b, n in zip(blocks, _weights(blocks, noise)):
        total += n
        if b.mark is not None:
            held[b.mark] = held.get(b.mark, 0) + n
            up = b.mark.up
            while up is not None and up not in held:
                held[up], up = 0, up.up
    marks = sorted(held, key=lambda m: m.number)
    main, article = ({m for m in marks if m.main}, {m for m in marks if m.article})
    for m in reversed(marks):
        if m.up is not None:
            held[m.up] += held[m]
            main |= {m.up} if m in main else set()
            article |= {m.up} if m in article else set()
    named: dict[str, int] = {}
    around: Counter[str] = Counter()
    walk: list[tuple[Mark, set[str]]] = []
    for m in marks:  # in page order, so the marks around one are on the walk
        while walk and walk[-1][0] is not m.up:
            around.subtract(walk.pop()[1])
        names = {x.lower() for x in m.names}
        for name in names:
            if not around[name]:
                named[name] = named.get(name, 0) + held[m]
        around.update(names)
        walk.append((m, names))
    only = not any((b.article or b.main) and b.mark is None for b in blocks)

    def much(n: int, alone: bool) -> bool:
        return 2 * n > total if alone else 10 * n > 9 * total

    most = [x for x, n in named.items() if much(n, only)]
    heads = tuple(x + c for x in most for c in "-_")
    taken: set[Mark] = set()
    weak: set[Mark] = set()  # words alone do not remove these
    for m in marks:
        spared = (m in main or much(held[m], only or m in article) or only and m in article and 3 * held[m] >= total > 0
                  or all(x.lower() in most or heads and x.lower().startswith(heads) for x in m.names))
        if m.up in taken or not spared and (m.strong or not m.inside):
            taken.add(m)
        elif not spared:
            weak.add(m)
    return [b for b in blocks if b.mark not in taken and not (b.mark in weak and b.path in noise)] or blocks


def _inside(blocks: list[Block], noise: frozenset[int] | set[int]) -> list[Block]:
    """The blocks in ``main``, else in any article or ``main``, if they hold half of the text."""
    weights = _weights(blocks, noise)
    for holds in (lambda b: b.main, lambda b: b.article or b.main):
        if 2 * sum(n for b, n in zip(blocks, weights) if holds(b)) >= sum(weights):
            found = [b for b in blocks if holds(b)]
            if found:
                return found
    return []


def _menus(blocks: list[Block]) -> set[int]:
    """Numbers of the blocks that are nearly all link and stand among others of the kind."""
    out, run = set(), []
    for k, b in enumerate([*blocks, None]):
        if b is not None and b.links >= 0.8 * len(b.text):
            run.append(k)
            continue
        if len(run) >= LINK_RUN:
            out.update(i for i in run if blocks[i].tag not in HEADINGS)
        run = []
    return out


def main_text(blocks: list[Block], noise: frozenset[int] | set[int]) -> str:
    """The page's main text, given the noise paths of its host."""
    some = _unmarked([b for b in blocks if not b.noise], noise)
    inside = _inside(some, noise)
    if inside:
        titles = [b for b in some if b.tag == "h1"]
        lead = [titles[0]] if len(titles) == 1 and not (titles[0].main or titles[0].article) else []
        before = lead and some.index(lead[0]) < some.index(inside[0]) and lead[0].path not in noise
        some = lead + inside if before else inside
    else:
        menus = _menus(some)
        some = [b for k, b in enumerate(some) if k not in menus] or some
    kept = [b for b in some if b.path not in noise or inside and (b.article or b.bare)]
    return "\n\n".join(b.text for b in kept or some)


#: The host of a url, an address in brackets as a whole; the same pattern serves Spark and Python.
HOST = r"^[^/?#]*//(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:]*)"
_HOST = re.compile(HOST)


def host_of(url: str | None) -> str:
    found = _HOST.search(url or "")
    return found[1].translate(_ASCII_LOWER) if found else ""


_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
_PAGE, _CONTENT, _LAYOUT = 0, 1, 2


def _own_text(blocks: list[Block]) -> int:
    """What pages with the same text of their own have in common."""
    own = [b.text for b in blocks if not b.noise and b.mark is None]
    return _hash("\n\n".join(own or [b.text for b in blocks]))


def distinct_pages(pages: DataFrame) -> DataFrame:
    """(host, features): one page of those of a host that have the same text of their own.

    ``features`` holds its (path, kind, feature) triples as 64-bit integers; of copies
    that differ elsewhere the one with the smallest bytes stands for all.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, own, features = [], [], []
            for url, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                host = host_of(url)
                if not host or not html:
                    continue
                blocks, layouts = parse(html)
                seen = {(x.path, _CONTENT, _hash(x.text)) for x in blocks}
                seen |= {(path, _LAYOUT, layout) for path, layout in layouts}
                hosts.append(host)
                own.append(_own_text(blocks))
                features.append(np.array(sorted(seen), np.int64).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(own, pa.int64()), pa.array(features, pa.binary())],
                names=["host", "own", "features"])

    return (map_arrow(pages.select("url", "html"), run, "host string, own bigint, features binary")
            .groupBy("host", "own").agg(F.min("features").alias("features")))


def count_features(pages: DataFrame) -> DataFrame:
    """(host, path, kind, feature, n): distinct pages of a host with a feature of a node, summed per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(counts: Counter) -> pa.RecordBatch:
            host, path, kind, feature = zip(*counts)
            return pa.RecordBatch.from_arrays(
                [pa.array(host), pa.array(path, pa.int64()), pa.array(kind, pa.int32()),
                 pa.array(feature, pa.int64()), pa.array(list(counts.values()), pa.int64())],
                names=["host", "path", "kind", "feature", "n"])

        counts: Counter = Counter()
        for b in batches:
            for host, features in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen = {(host, *x) for x in np.frombuffer(features, np.int64).reshape(-1, 3).tolist()}
                seen |= {(host, path, _PAGE, 0) for _, path, _, _ in seen}
                counts.update(seen)
                if len(counts) > 100_000:
                    yield rows(counts)
                    counts = Counter()
        if counts:
            yield rows(counts)

    return (map_arrow(distinct_pages(pages).select("host", "features"), run,
                      "host string, path bigint, kind int, feature bigint, n bigint")
            .groupBy("host", "path", "kind", "feature").agg(F.sum("n").alias("n")))


def noise_paths(features: DataFrame, threshold: float = THRESHOLD, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, path) of the nodes whose presentation and content importance are both low."""
    def only(kind: int, value) -> F.Column:
        return F.when(F.col("kind") == kind, value)

    n = F.col("n").cast("double")
    sums = features.groupBy("host", "path").agg(
        F.max(only(_PAGE, n)).alias("m"), F.avg(only(_CONTENT, F.log(n))).alias("content"),
        F.sum(only(_LAYOUT, n)).alias("laid"), F.sum(only(_LAYOUT, n * F.log(n))).alias("n_log_n"))
    base = F.log("m")
    content = 1 - F.col("content") / base
    layout = (F.log("laid") - F.col("n_log_n") / F.col("laid")) / base
    return (sums.where(F.col("m") >= max(min_pages, 2))
            .where(F.col("content").isNotNull() & (content < threshold))
            .where(F.coalesce(layout, F.lit(0.0)) < threshold)
            .select("host", "path"))


def extract(pages: DataFrame, threshold: float = THRESHOLD, min_pages: int = MIN_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages(page_id, url, html, ...)``."""
    checkpoint_root(pages.sparkSession)
    plain = pages.select("page_id", "url", "html")
    noise = noise_paths(count_features(plain), threshold, min_pages).checkpoint()
    by_host = noise.groupBy("host").agg(F.collect_set("path").alias("paths"))
    host = F.coalesce(ascii_lower(F.regexp_extract("url", HOST, 1)), F.lit(""))
    keyed = plain.withColumn("host", host)
    if noise.count() <= BROADCAST_PATHS:
        joined = keyed.join(F.broadcast(by_host), "host", "left")
    else:
        salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
        spread = by_host.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = keyed.withColumn("salt", salt).join(spread, ["host", "salt"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(parse(html)[0], set(paths or ())) if html else ""
                     for html, paths in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())],
                                             names=["page_id", "url", "text"])

    schema = T.StructType([plain.schema["page_id"], plain.schema["url"], T.StructField("text", T.StringType())])
    return (map_arrow(joined.select("page_id", "url", "html", "paths"), run, schema)
            .withColumn("n_chars", F.char_length("text").cast("bigint")))
