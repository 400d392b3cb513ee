"""Operator 8: main text of web pages by wrapper induction.

Each page is parsed into its tree of structural elements (inline markup is transparent; siblings of one signature, tag and
class, are folded into one repeated node), with text blocks at the nodes. Per host the most frequent tree is the reference; the
host's other trees are aligned to it by simple tree matching, so that every block of every page gets a slot. All counts are of
distinct pages: pages of equal main blocks are one page, and a text counts once per page. A text that stands in its slot on
TEMPLATE_SHARE of the host's pages (inside an article: ARTICLE_SHARE) is template (menus, notices, footers) and only that text, never the rest of its slot; slots
whose other texts differ from page to page are content, and the deepest element that holds most of their text, each page weighed
equally, is the host's content region. A page's main text is its article or main element; on pages without one it is the
region's blocks and the content slots beside it (a headline, say). Template texts are left out, and so are elements
that are boilerplate by name (nav, header outside the article, footer, aside, form, script, style, ..., or a class, id or role
such as ad, cookie, sidebar, comments). Inside an article only whole class words count, and a name counts neither on the article, nor on an
element that holds the page's largest article or most of the text of the one it stands in. Unread elements (script, svg, ...) end no block. An article that would lose more than half its characters as template texts is a near copy
of others, and stays whole. Pages of hosts with fewer than MIN_PAGES distinct pages have no wrapper: there the main
text is the article or main element, or else the body.

Two scans: the first gives out hashes and weights of each distinct page's blocks, which are counted by (host, slot, text hash) in
partial sums, so a host with a third of all pages is a few numbers per task; alignment works on distinct trees. The second
extracts with one wrapper per host, which is broadcast
if all wrappers together stay below BROADCAST_CHARS and joined by host otherwise. Pages themselves are only shuffled in that
second case.

Defined results: null or empty html gives an empty text; a null or malformed url has no host, and so no wrapper; blocks are
separated by two newlines, white space inside a block is one space; every row gives one row, repeated rows and null page_ids
included; only page_id, url and html are read; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.frames import staged

MIN_PAGES = 5
TEMPLATE_PAGES = 20  # a text must stand on so many distinct pages before it can be template
TEMPLATE_SHARE = 0.5  # and on this share of the host's distinct pages
ARTICLE_SHARE = 0.9  # inside an article: a subheading or byline of half the pages is the article's own
MOST_SHARED = 0.1  # share of the other pages that have a slot's text, on the mean, above which the slot is no content
REGION_SHARE = 0.7
PAGE_WEIGHT = 1_000_000
BROADCAST_CHARS = 16_000_000

# HTML element names.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
                   "strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
UNREAD = frozenset("script style noscript template svg math iframe object canvas audio video map select datalist head title "
                   "textarea".split())
RAW = frozenset("script style textarea title".split())
BOILERPLATE = frozenset("nav footer aside form button dialog menu fieldset".split())
ARTICLE = frozenset("article main".split())
ENDS_PARAGRAPH = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
                           "h6 header hr main menu nav ol p pre section table ul".split())
CLOSES_LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
               "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table body html article section div main".split())

NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|gdpr|header|masthead|menu|modal|"
    r"nav\w*|newsletter|notice|pagination|popup|promo\w*|related|replies|respond|share|sharing|sidebar|skip|social|sponsor\w*|"
    r"subscribe|tags|toolbar|widget|complementary|contentinfo|navigation|search)(?:$|[\s_-])", re.I)
# Inside an article whole class tokens only: the name, alone or with one general word before or behind it.
_INNER = (r"ads?|advert(?:s|isements?|ising)?|banner|breadcrumbs?|comments?|consent|cookies?|disqus|gdpr|menu|modal|nav|navigation|newsletter|"
          r"notices?|pagination|popup|promos?|promotions?|related|replies|respond|share|sharing|sidebar|skip|social|sponsor(?:s|ed)?|subscribe|"
          r"tags|toolbar|widget|complementary|contentinfo|search|footer")
_BEFORE = r"article|post|entry|page|site|content|main|left|right|top|bottom|reader|user|inline|cookie|social|related|text|native"
_BEHIND = (r"area|articles?|bar|banner|block|box|buttons?|container|content|form|group|icons?|inner|items?|links?|list|notice|panel|posts?|section|"
           r"signup|slot|stories|text|thread|unit|widget|wrap|wrapper")
NAMED_INSIDE = re.compile(rf"(?:(?:{_BEFORE})[-_]+)?(?:{_INNER})(?:[-_]+(?:{_BEHIND}))?(?:[-_]*\d+)?", re.I)
HEAD = frozenset("title meta link script style base noscript template".split())
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)(?:>|$)",
                   re.S)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
HOST = r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"

Path = tuple[str, ...]


class Page:
    """Text blocks of a page with the path of structural elements that hold them."""

    def __init__(self, html: str):
        self.blocks: list[tuple[Path, str, bool, bool]] = []  # path, text, boilerplate by name, inside an article
        self.has_article = False
        #: blocks as read: path, text, unread or hidden or a boilerplate element, elements named as boilerplate, outermost article
        self._raw: list[tuple[Path, str, bool, tuple[int, ...], int | None]] = []
        self._named_inside: set[int] = set()
        self._above: dict[int, tuple[int, ...]] = {}  # article -> elements that it stands in
        self._parse(html or "")
        self._judge()

    def _judge(self) -> None:
        """A name makes an element boilerplate unless it holds the page's main article, or most of the article that it stands in."""
        chars: Counter = Counter()
        for _, text, bad, named, article in self._raw:
            if article is not None and not bad:
                chars["article", article] += len(text)
                for element in named:
                    chars[element] += len(text)
        articles = [key[1] for key in chars if isinstance(key, tuple)]
        main = max(articles, key=lambda a: (chars["article", a], -a), default=None)
        wrapping = set(self._above.get(main, ()))
        for path, text, bad, named, article in self._raw:
            most = chars["article", article] / 2
            bad = bad or any(e not in wrapping and not (e in self._named_inside and chars[e] > most) for e in named)
            self.blocks.append((path, text, bad, article is not None))

    def _parse(self, html: str) -> None:
        # open elements: tag, path, unread or boilerplate, named elements, outermost article, number
        stack: list[tuple[str, Path, bool, tuple[int, ...], int | None, int]] = [("", (), False, (), None, 0)]
        text: list[str] = []
        skipped: list[str] = []  # open elements from an unread one on: their content is dropped, and ends no block
        at, size, number = 0, len(html), 0

        def flush() -> None:
            if text:
                _, path, bad, named, article, _ = stack[-1]
                words = " ".join(unescape("".join(text)).split())
                if words:
                    self._raw.append((path, words, bad, named, article))
                text.clear()

        def close(position: int) -> None:
            flush()
            del stack[position:]

        while at < size:
            m = TOKEN.search(html, at)
            if m is None:
                if not skipped:
                    text.append(html[at:])
                break
            if m.start() > at and not skipped:
                text.append(html[at:m.start()])
            at = m.end()
            if not m.group(2):
                continue
            tag, closing = m.group(2).lower(), bool(m.group(1))
            if skipped:
                if not closing:
                    if tag in RAW:
                        end = re.compile(f"</{tag}", re.I).search(html, at)
                        at = end.start() if end else size
                    if tag not in VOID and not m.group(3).rstrip().endswith("/"):
                        skipped.append(tag)
                    continue
                if tag in skipped:
                    del skipped[len(skipped) - 1 - skipped[::-1].index(tag):]
                    continue
                if not any(x[0] == tag for x in stack):
                    continue
                skipped.clear()  # an element outside is closed: the unread one was left open
            if tag in INLINE:
                continue
            if closing:
                if tag == "br":
                    text.append(" ")
                    continue
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        close(i)
                        break
                else:
                    if tag not in UNREAD:
                        flush()
                continue
            if stack[-1][0] == "head" and tag not in HEAD:
                close(len(stack) - 1)
            if tag in VOID:
                if tag == "hr":
                    flush()
                else:
                    text.append(" ")
                continue
            if tag in UNREAD and tag != "head":
                if tag in RAW:
                    end = re.compile(f"</{tag}", re.I).search(html, at)
                    at = end.start() if end else size
                if not m.group(3).rstrip().endswith("/"):
                    skipped.append(tag)
                text.append(" ")
                continue
            flush()
            if tag in ENDS_PARAGRAPH:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p":
                        close(i)
                        break
                    if stack[i][0] in SCOPE:
                        break
            like = CLOSES_LIKE.get(tag)
            if like:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in like:
                        close(i)
                        break
                    if stack[i][0] in SCOPE:
                        break
            number += 1
            _, path, bad, named, article, _ = stack[-1]
            words, hidden = _names(m.group(3))
            within = article is not None
            if tag in ARTICLE and not within:
                article, self.has_article = number, True
                self._above[number] = tuple(x[5] for x in stack)
            bad = bad or tag in BOILERPLATE or tag == "head" or (tag == "header" and article is None) or hidden
            if within and any(NAMED_INSIDE.fullmatch(word) for word in words.split()):
                self._named_inside.add(number)
                named = (*named, number)
            elif article is None and tag not in ("html", "body") and NAMED.search(words):
                named = (*named, number)
            signature = f"{tag}.{_plain(words)}" if words else tag
            stack.append((tag, (*path, signature), bad, named, article, number))
        flush()

    def paths(self) -> tuple[Path, ...]:
        """The folded tree: distinct block paths in page order."""
        return tuple(dict.fromkeys(b[0] for b in self.blocks))


def _names(attributes: str) -> tuple[str, bool]:
    """Class, id and role words of a tag, and whether it is hidden."""
    if not attributes or attributes.isspace():
        return "", False
    words, hidden = [], False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id", "role"):
            words.append(value)
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (
                name == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            hidden = True
    return " ".join(words), hidden


def _plain(words: str) -> str:
    """Class words without numbers, so that numbered ids have one signature."""
    return re.sub(r"[\d/\s]+", "_", words)


class Node:
    __slots__ = ("children", "path", "signature")

    def __init__(self, path: Path):
        self.path, self.signature, self.children = path, path[-1] if path else "", []


def tree(paths: tuple[Path, ...]) -> Node:
    """Folded tree of block paths; children in order of first appearance."""
    root = Node(())
    known: dict[Path, Node] = {(): root}
    for path in paths:
        for i in range(1, len(path) + 1):
            if path[:i] not in known:
                known[path[:i]] = Node(path[:i])
                known[path[:i - 1]].children.append(known[path[:i]])
    return root


def _heaviest(found: list[tuple[int, int, int]], m: int) -> list[int]:
    """Places in ``found`` (i, j, weight), sorted by i and falling j, of the heaviest choice in which i and j both rise. ``m``: number of j."""
    best = [(0, -1)] * (m + 1)  # prefix maxima over j, as a binary indexed tree: weight, place
    back: list[int] = []
    for place, (_, j, weight) in enumerate(found):
        total, before, k = 0, -1, j
        while k:
            if best[k][0] > total:
                total, before = best[k]
            k &= k - 1
        back.append(before)
        k = j + 1
        while k <= m:
            if best[k][0] < total + weight:
                best[k] = (total + weight, place)
            k += k & -k
    total, place, k = 0, -1, m
    while k:
        if best[k][0] > total:
            total, place = best[k]
        k &= k - 1
    chosen = []
    while place >= 0:
        chosen.append(place)
        place = back[place]
    return chosen[::-1]


def simple_tree_matching(a: Node, b: Node) -> tuple[int, list[tuple[Path, Path]]]:
    """Size and pairs of the largest order-keeping mapping of two trees that maps roots to roots and keeps parents.

    Only children of one signature can be mapped to each other, so those pairs are looked up by signature, and the best order-keeping choice
    among them is a heaviest rising sequence; in folded trees a signature is there once, so the work is near the trees' size. No recursion."""
    if a.signature != b.signature:
        return 0, []
    size: dict[tuple[int, int], int] = {}
    chosen: dict[tuple[int, int], list[tuple[Node, Node]]] = {}
    todo: list[tuple[Node, Node, list[tuple[int, int]] | None]] = [(a, b, None)]
    while todo:
        x, y, alike = todo.pop()
        if alike is None:
            places: dict[str, list[int]] = {}
            for j, child in enumerate(y.children):
                places.setdefault(child.signature, []).append(j)
            alike = [(i, j) for i, child in enumerate(x.children) for j in reversed(places.get(child.signature, ()))]
            todo.append((x, y, alike))
            todo += [(x.children[i], y.children[j], None) for i, j in alike]
        else:
            found = [(i, j, size[id(x.children[i]), id(y.children[j])]) for i, j in alike]
            kept = [found[k] for k in _heaviest(found, len(y.children))]
            size[id(x), id(y)] = 1 + sum(w for *_, w in kept)
            chosen[id(x), id(y)] = [(x.children[i], y.children[j]) for i, j, _ in kept]
    pairs, walk = [], [(a, b)]
    while walk:
        x, y = walk.pop()
        pairs.append((x.path, y.path))
        walk += chosen[id(x), id(y)]
    return size[id(a), id(b)], pairs


def slots(paths: tuple[Path, ...], reference: tuple[Path, ...]) -> dict[Path, Path]:
    """Reference path of each node of a page's tree; unmatched nodes are absent."""
    return dict(simple_tree_matching(tree(paths), tree(reference))[1])


def spell(paths: tuple[Path, ...]) -> str:
    return json.dumps(paths, ensure_ascii=False)


def unspell(text: str) -> tuple[Path, ...]:
    return tuple(tuple(p) for p in json.loads(text))


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


COUNTS = "host string, page bigint, rest bigint, tree bigint, blocks array<struct<path: bigint, text: bigint, weight: bigint>>, spelled string"
BLOCK = pa.list_(pa.struct([("path", pa.int64()), ("text", pa.int64()), ("weight", pa.int64())]))


def main_blocks(page: Page) -> list[tuple[Path, str, bool, bool]]:
    """Blocks that are not boilerplate by name, of the article if there is one."""
    good = [b for b in page.blocks if not b[2]]
    return [b for b in good if b[3]] if page.has_article else good


def _page_row(page: Page, path_hash: dict[Path, int]) -> tuple[int, int, list[tuple[int, int, int]]]:
    """(key of the main blocks, key of all blocks, distinct blocks with their part of the page's text) of a page."""
    hashes = {text: _hash(text) for _, text, *_ in page.blocks}
    keys = [hash_of([(path_hash[b[0]], hashes[b[1]]) for b in blocks]) for blocks in (main_blocks(page) or page.blocks, page.blocks)]
    chars: Counter = Counter()
    for path, text, bad, _ in page.blocks:
        chars[path_hash[path], hashes[text]] += 0 if bad else len(text)
    total = max(sum(chars.values()), 1)
    return keys[0], keys[1], [(p, t, n * PAGE_WEIGHT // total) for (p, t), n in chars.items()]


def hash_of(pairs: list[tuple[int, int]]) -> int:
    return xxhash.xxh64_intdigest(np.array(pairs, np.int64).tobytes()) - (1 << 63)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct pages with their blocks, and the distinct trees."""
    for batch in batches:
        rows: dict[tuple, tuple] = {}
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            page = Page(html)
            paths = page.paths()
            name = spell(paths)
            key = _hash(name)
            rows[host, key, name] = (host, None, None, key, None, name)
            main, rest, blocks = _page_row(page, {p: _hash(spell((p,))) for p in paths})
            rows[host, main, rest, key] = (host, main, rest, key, blocks, None)
        kinds = (pa.string(), *[pa.int64()] * 3, BLOCK, pa.string())
        columns = list(zip(*rows.values(), strict=True)) if rows else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                         ["host", "page", "rest", "tree", "blocks", "spelled"])


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slot (path of the host's reference) of each path of each tree."""
    for batch in batches:
        out = []
        for host, key, own, reference in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            paths, ref = unspell(own), unspell(reference)
            for p, q in slots(paths, ref).items():
                if p in paths and q in ref:
                    out.append((host, key, _hash(spell((p,))), json.dumps(q, ensure_ascii=False)))
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                         ["host", "tree", "path", "slot"])


def _named_bad(path: Path) -> bool:
    inside = False
    for signature in path:
        tag, _, words = signature.partition(".")
        inside = inside or tag in ARTICLE
        if tag in BOILERPLATE or (tag == "header" and not inside) or (tag not in ("html", "body") and NAMED.search(words.replace("_", " "))):
            return True
    return False


def induce(reference: tuple[Path, ...], stats: dict[Path, tuple[float, int]]) -> tuple[Path, list[Path]]:
    """(content region, content slots) of a host from (share of the other pages with the same text, weight) of its slots."""
    varying: Counter = Counter()
    content = [path for path, (shared, _) in stats.items() if shared <= MOST_SHARED and not _named_bad(path)]
    for path in content:
        for i in range(len(path) + 1):
            varying[path[:i]] += stats[path][1]
    total, region = varying[()], ()
    while total:
        below = [p for p in varying if len(p) == len(region) + 1 and p[:len(region)] == region and varying[p] >= REGION_SHARE * total]
        # a text block of its own is no region
        if not below or below[0] in reference:
            break
        region = below[0]
    return region, content


def _induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        wrappers = []
        for reference, rows in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            region, content = induce(unspell(reference), {tuple(json.loads(r["slot"])): (r["shared"], r["weight"]) for r in rows
                                                          if r["weight"]})
            kept = {k: [(json.loads(r["slot"]), r[k]) for r in rows if r[k]] for k in ("template", "fixed")}
            wrappers.append(json.dumps({"reference": json.loads(reference), "region": region, "content": content, **kept}, ensure_ascii=False))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(wrappers, pa.string())], ["host", "wrapper"])


def learn_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) of every host with enough distinct pages, from all pages (host, html)."""
    counts = staged(pages.where("host is not null").select("host", "html").mapInArrow(_count, COUNTS), "html-counts")
    # of pages with the same main blocks one is counted, the same in every run
    distinct = staged(counts.where("spelled is null").groupBy("host", "page").agg(F.min(F.struct("rest", "tree", "blocks")).alias("p"))
                      .select("host", "p.tree", "p.blocks"), "html-pages")
    spelled = counts.where("spelled is not null").select("host", "tree", "spelled").distinct()
    trees = distinct.groupBy("host", "tree").agg(F.count("*").alias("pages")).join(spelled, ["host", "tree"])
    frequent = (trees.groupBy("host").agg(F.max(F.struct("pages", "tree", "spelled")).alias("top"), F.sum("pages").alias("pages"))
                .where(F.col("pages") >= MIN_PAGES).select("host", "pages", F.col("top.spelled").alias("reference")))
    frequent = staged(frequent, "html-references")
    aligned = staged(trees.join(frequent.select("host", "reference"), "host").select("host", "tree", "spelled", "reference")
                     .mapInArrow(_align, "host string, tree bigint, path bigint, slot string"), "html-slots")
    # a page's slot has one path, so that a text counts once per page
    blocks = (distinct.select("host", "tree", F.explode("blocks").alias("b")).groupBy("host", "tree", "b.path", "b.text")
              .agg(F.count("*").alias("n"), F.sum("b.weight").alias("weight"))
              .join(aligned, ["host", "tree", "path"]).groupBy("host", "slot", "text").agg(F.sum("n").alias("n"), F.sum("weight").alias("weight"))
              .join(frequent.select("host", "pages"), "host"))
    template = (F.col("n") >= TEMPLATE_PAGES) & (F.col("n") >= TEMPLATE_SHARE * F.col("pages"))
    others = F.when(~template, F.col("n"))
    # a page has so many of a slot's template texts at least, so they are few
    stats = blocks.groupBy("host", "slot").agg(
        (F.sum(others.cast("double") * (F.col("n") - 1)) / (F.sum(others) * (F.max("pages") - 1))).alias("shared"),
        F.coalesce(F.sum(F.when(~template, F.col("weight"))), F.lit(0)).alias("weight"),
        F.sort_array(F.collect_list(F.when(template, F.col("text")))).alias("template"),
        F.sort_array(F.collect_list(F.when(template & (F.col("n") >= ARTICLE_SHARE * F.col("pages")), F.col("text")))).alias("fixed"))
    # slots of a host are at most the paths of its reference page
    per_host = stats.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("slot", "shared", "weight", "template", "fixed"))).alias("slots"))
    return frequent.join(per_host, "host").select("host", "reference", "slots").mapInArrow(_induce, "host string, wrapper string")


class Wrapper:
    """A host's wrapper, applied to pages; alignments are kept per distinct tree."""

    def __init__(self, spelled: str):
        w = json.loads(spelled)
        self.reference = tuple(tuple(p) for p in w["reference"])
        self.region, self.content = tuple(w["region"]), {tuple(p) for p in w["content"]}
        self.template, self.fixed = ({tuple(p): frozenset(texts) for p, texts in w[k]} for k in ("template", "fixed"))
        self.known: dict[tuple[Path, ...], tuple[Path | None, set[Path], dict[Path, frozenset[int]], dict[Path, frozenset[int]]]] = {}

    def on(self, paths: tuple[Path, ...]) -> tuple[Path | None, set[Path], dict[Path, frozenset[int]], dict[Path, frozenset[int]]]:
        """The region of a page's tree, None if it has none, its content paths, and its paths' template texts, on any page and in articles."""
        if paths not in self.known:
            if len(self.known) > 1000:
                self.known.clear()
            mapped = slots(paths, self.reference)
            region = next((p for p, q in mapped.items() if q == self.region), None)
            self.known[paths] = (region, {p for p, q in mapped.items() if q in self.content},
                                 *({p: texts[q] for p, q in mapped.items() if q in texts} for texts in (self.template, self.fixed)))
        return self.known[paths]


def main_text(html: str | None, wrapper: Wrapper | None) -> str:
    page = Page(html or "")
    inside = main_blocks(page)
    if wrapper is not None:
        region, content, template, fixed = wrapper.on(page.paths())
        template = fixed if page.has_article else template
        near = inside
        # an article is never narrowed
        if region is not None and not page.has_article:
            near = [b for b in inside if b[0][:len(region)] == region or b[0] in content]
        own = [b for b in near if b[0] not in template or _hash(b[1]) not in template[b[0]]]
        least = sum(len(b[1]) for b in near) / 2 if page.has_article else 1
        if sum(len(b[1]) for b in own) >= least:
            inside = own
    return "\n\n".join(b[1] for b in inside)


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    host = F.lower(F.regexp_extract("url", HOST, 1))
    rows = rows.withColumn("host", F.when(host != "", host))
    wrappers = staged(learn_wrappers(rows), "html-wrappers")
    size = wrappers.agg(F.coalesce(F.sum(F.length("wrapper") + F.length("host")), F.lit(0)).alias("chars")).first()["chars"]
    known = None
    if size <= BROADCAST_CHARS:
        known = pages.sparkSession.sparkContext.broadcast({r["host"]: r["wrapper"] for r in wrappers.collect()})
        rows = rows.withColumn("wrapper", F.lit(None).cast("string"))
    else:
        rows = rows.join(wrappers, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built: dict[str, Wrapper] = {}
        for batch in batches:
            texts = []
            for html, host, spelled in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                spelled = known.value.get(host) if known is not None else spelled
                if spelled is not None and host not in built:
                    if len(built) > 1000:
                        built.clear()
                    built[host] = Wrapper(spelled)
                texts.append(main_text(html, built.get(host) if spelled is not None else None))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return rows.select("page_id", "url", "html", "host", "wrapper").mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
