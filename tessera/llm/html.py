"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree: an element node is a path of tags with
their classes; its presentation styles are the sequences of child elements it has on
different pages, its contents the texts directly in it. A node's importance is the
entropy of its styles or contents over the pages, to the base of the number of pages (1
for a single page): what every page repeats is worth nothing, what always differs is
worth 1. The importance of a branch is the mean over its nodes, each counting less by
``DECAY`` for each level that it lies deeper. A text on n of the m pages that have its
element is worth 1 - log n / log m, since others of the same element may differ. All are
smoothed by ``PRIOR`` pages of importance 1, so that a few pages weigh less. Branches below ``LEAST`` and texts
below ``REPEATED`` are cut. Equal pages, and pages of equal articles, count once, so that
copies don't make a text look like a template.

Where a page marks its article (or main) element, only what is in it is text. The mark is
a prior: in it branches, too, are cut only below ``REPEATED``, and nothing is cut where that
would take half of its characters or more, since pages that share so much are copies.

What elements say of themselves is used beside the tree, since a host may have one page:
by tag, role or class they are menus, headers, footers, sidebars, notices, adverts,
forms or comments, and such branches go. A class says so by its whole name or its head,
the last word ("no-sidebar" doesn't). It never takes an article or main element, or what
holds one, except for comments after the first article. ``WEAK`` words name parts of an
article as well ("tags", "notice"): in a marked one they only double the importance below
which the tree cuts, and outside the tree may overrule them on hosts of ``ENOUGH`` pages.

Counting is partial sums per node and value; the tree's cut branches are a sorted hash
array that workers map, so pages are never shuffled, and no host is in one task.

Defined cases: a null or empty page has the text ''. A null url is a host of its own kind
(''). Unclosed elements end with their parent; ``p`` ends before the next block. Repeated
rows have equal results. Columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import collections
import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import mapped
from .shared import lean, table, written

DECAY, LEAST, REPEATED, PRIOR, ENOUGH = 0.9, 0.3, 0.15, 0.5, 5

# Names of HTML elements and words in class, id and role attributes.
SKIPPED = frozenset("script style noscript template iframe svg canvas embed select datalist textarea title video audio map".split())
FURNITURE = frozenset("nav footer aside form menu dialog button fieldset".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small strike strong sub sup time tt u var wbr br input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_PARAGRAPH = frozenset("address article aside blockquote details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
ENDS_SAME = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr"}, "th": {"tr"}, "option": {"select"}, "p": set()}
MAIN = frozenset("article main".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disclaimer discussion disqus "
    "foot footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion related replies reply respond responses "
    "search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar topbar widget widgets".split()
)

#: Words that also name parts of an article; words of comments; what follows a head ("ad-slot"), and what denies it.
WEAK = frozenset("banner banners copyright disclaimer discussion foot footer header login masthead menu modal notice notices promotion related reply responses search social tags".split())
REMARKS = frozenset("comment comments commentlist discussion disqus replies reply respond responses".split())
HOLDERS = frozenset("area bar block box container inner links list section slot unit wrap wrapper".split())
DENIED = frozenset("has is no not with without".split())
SURE, HINT = 2, 1

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)


def _said(names: str) -> set[str]:
    """The words that class names say of an element: each whole name, or its head."""
    out = set()
    for name in names.split():
        parts = [x.lower() for x in re.split(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])", name) if x]
        if len(parts) == 2 and parts[1] in HOLDERS:
            parts.pop()
        if parts and parts[0] not in DENIED:
            out.add(parts[-1])
    return out


def _marks(tag: str, attributes: str) -> tuple[str, bool, set[str]]:
    """An element's name in the tree, whether its tag or role says that it isn't text of the article, and what its class does."""
    if not attributes.strip():
        return tag, tag in FURNITURE, set()
    found = {k.lower(): (v or "").strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}
    said = _said(f"{found.get('class', '')} {found.get('id', '')}") & WORDS
    away = tag in FURNITURE or found.get("role", "").lower() in ROLES or "hidden" in found or found.get("aria-hidden") == "true"
    return f"{tag}.{found.get('class', '')}", away, said


class Page:
    """The blocks of text of a page with their places in the tree, and the styles of its elements."""

    def __init__(self, source: str):
        #: Of each block: the path's number and the pieces of its text. Of each path: its last name, whether in an article, whether furniture, its parent, what its class says.
        self.blocks: list[tuple[int, list[str]]] = []
        self.names = [""]
        self.inside, self.away, self.styles = [False], [False], [[]]
        self.parents, self.said, self.marks = [0], [set()], []
        self._read(source)
        self._judge()

    def _judge(self):
        """``hints``: how the class of each path counts; where it is sure, what is in the element is furniture."""
        holds, first = set(), set()
        for k in self.marks:
            while k not in holds:
                holds.add(k)
                k = self.parents[k]
            first = first or set(holds)
        self.hints = [0] * len(self.names)
        for k in range(1, len(self.names)):
            said = self.said[k]
            if k in first or k in holds and not said & REMARKS:
                said = set()
            self.hints[k] = SURE if said - WEAK else HINT if said else 0
            if self.hints[k] == SURE or self.away[self.parents[k]]:
                self.away[k] = True

    def keys(self, host: str) -> list[int]:
        """A hash of host and path for each path, from that of its parent."""
        out = [_hash(host)]
        for k in range(1, len(self.names)):
            out.append(_hash(out[self.parents[k]], self.names[k]))
        return out

    def above(self, k: int, most: int) -> list[int]:
        """The paths from the root (or ``most`` levels above) down to path ``k``."""
        out = [k]
        while k and len(out) < most:
            k = self.parents[k]
            out.append(k)
        return out[::-1]

    def _read(self, source: str):
        stack, at, fresh, skip, opened = [("", 0)], 0, True, None, collections.Counter()

        def close(k):
            opened.subtract(x[0] for x in stack[k:])
            del stack[k:]

        for m in _TOKEN.finditer(source):
            tag = m[2]
            if skip:
                if tag and m[1] and tag.lower() == skip:
                    skip = None
                    at = m.end()
                continue
            if m.start() > at:
                fresh = self._text(source[at : m.start()], stack[-1][1], fresh)
            at = m.end()
            if not tag:
                continue
            tag = tag.lower()
            if tag in SKIPPED:
                skip = None if m[1] or m[3].endswith("/") else tag
            elif tag in INLINE:
                if tag == "br":
                    fresh = self._text(" ", stack[-1][1], fresh)
            elif m[1]:
                fresh = True
                for k in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                    if stack[k][0] == tag:
                        close(k)
                        break
            else:
                fresh = True
                self._implied(stack, tag, opened, close)
                if tag in VOID:
                    continue
                name, away, said = _marks(tag, m[3])
                parent = stack[-1][1]
                inside = self.inside[parent] or tag in MAIN
                if tag == "header" and not self.inside[parent]:
                    away = True
                if tag in MAIN:
                    self.marks.append(len(self.names))
                self.parents.append(parent)
                self.said.append(said if tag not in ("html", "body") else set())
                self.styles[parent].append(name)
                self.names.append(name)
                self.inside.append(inside)
                self.away.append(self.away[parent] or (away and tag not in ("html", "body", "main")))
                self.styles.append([])
                stack.append((tag, len(self.names) - 1))
                opened[tag] += 1
        if not skip and at < len(source):
            self._text(source[at:], stack[-1][1], fresh)

    def _implied(self, stack, tag, opened, close):
        """End what the start of ``tag`` ends."""
        ends = {"p"} if tag in ENDS_PARAGRAPH else set()
        stop = ENDS_SAME.get(tag)
        if stop is not None:
            ends = ends | ({"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else {"tr", "td", "th"} if tag == "tr" else {tag})
        for k in range(len(stack) - 1, 0, -1) if any(opened[x] for x in ends) else ():
            if stack[k][0] in ends:
                close(k)
            elif stop and stack[k][0] in stop or stack[k][0] in ("div", "section", "article", "main", "body"):
                break

    def _text(self, text: str, node: int, fresh: bool) -> bool:
        if fresh or not self.blocks or self.blocks[-1][0] != node:
            if text.isspace():
                return fresh
            self.blocks.append((node, [text]))
        else:
            self.blocks[-1][1].append(text)
        return False

    def texts(self) -> list[tuple[int, str]]:
        """The node and the text of each block that has any."""
        found = ((node, " ".join(html.unescape("".join(parts)).split())) for node, parts in self.blocks)
        return [(node, x) for node, x in found if x]


def _hash(*parts) -> int:
    """64 bits that depend on the parts alone."""
    import xxhash

    return xxhash.xxh64_intdigest("\0".join(map(str, parts)).encode("utf-8", "surrogatepass"))


def host_of(url: str | None) -> str:
    """The host of a url without a leading ``www.``, in lower case."""
    found = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "", re.I)
    return found[1].lower().removeprefix("www.") if found else ""


def _rows(batch: pa.RecordBatch):
    return zip(batch.column("url").to_pylist(), batch.column("html").to_pylist())


def importances(pages: DataFrame, decay: float = DECAY) -> DataFrame:
    """``key``, ``importance`` and ``pages`` of branches (a hash of host and path) and texts (the same with the text's hash) on two pages or more."""

    # a node so much deeper weighs less than the rounding of a double
    reach = 2 + int(np.ceil(np.log(2.0**-60) / np.log(decay)))

    def observe(batches):
        """A row for each value (style or content) of each node of each page, and one of value 0 for the page itself."""
        for batch in batches:
            out: dict[str, list] = {"node": [], "chain": [], "value": [], "content": [], "page": []}
            for url, source in _rows(batch):
                page, host = Page(source or ""), host_of(url)
                texts = page.texts()
                key = _hash(*([x for k, x in texts if page.inside[k]] or [source or ""]))
                nodes = page.keys(host)
                values = [(k, _hash("s", *s), False) for k, s in enumerate(page.styles) if s] + [(k, _hash("c", x), True) for k, x in texts]
                distinct = {(nodes[k], value): (k, content) for k, value, content in values}
                distinct |= {(nodes[k], 0): (k, False) for k, _, _ in values}
                chains = {k: [nodes[j] for j in page.above(k, reach)] for k, _ in distinct.values()}
                for (node, value), (k, content) in distinct.items():
                    out["node"].append(node)
                    out["chain"].append(chains[k])
                    out["value"].append(value)
                    out["content"].append(content)
                    out["page"].append(key)
            u8 = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            chain = pa.ListArray.from_arrays(np.cumsum([0, *map(len, out["chain"])]).astype(np.int32), u8([y for x in out["chain"] for y in x]))
            yield pa.RecordBatch.from_arrays([u8(out["node"]), chain, u8(out["value"]), pa.array(out["content"], pa.bool_()), u8(out["page"])], ["node", "chain", "value", "content", "page"])

    seen = pages.select("url", "html").mapInArrow(lean(observe), "node long, chain array<long>, value long, content boolean, page long").distinct()
    counted = written(seen.groupBy("node", "chain", "value", "content").agg(F.count("*").alias("n")), "values")
    shown = F.sum(F.when(F.col("value") == 0, F.col("n")))
    real = F.when(F.col("value") != 0, F.col("n"))
    total = counted.groupBy("node", "chain").agg(F.sum(real).alias("m"), F.sum(real * F.log("n")).alias("s"), shown.alias("pages"))
    smooth = lambda x: (F.col("pages") * x + PRIOR) / (F.col("pages") + PRIOR)
    # the entropy to the base m: (log m - sum(n log n) / m) / log m
    own = total.select("chain", "m", "pages", F.when(F.col("m") > 1, 1 - F.col("s") / (F.col("m") * F.log(F.col("m").cast("double")))).otherwise(1.0).alias("importance"))
    weight = F.col("m") * F.pow(F.lit(decay), F.size("chain") - 1 - F.col("depth"))
    spread = own.select("m", "pages", "importance", "chain", F.posexplode("chain").alias("depth", "key")).withColumn("w", weight)
    nodes = spread.groupBy("key").agg(F.max("pages").alias("pages"), (F.sum(F.col("w") * F.col("importance")) / F.sum("w")).alias("importance")).filter("pages > 1")
    texts = counted.filter("content and n > 1").join(total.select("node", "pages"), "node").withColumn("importance", 1 - F.log("n") / F.log(F.col("pages").cast("double")))
    texts = texts.select(F.col("node").bitwiseXOR(F.col("value")).alias("key"), smooth(F.col("importance")).alias("importance"), "pages").filter(F.col("importance") < REPEATED)
    return nodes.select("key", smooth(F.col("importance")).alias("importance"), "pages").union(texts)


def _kept(page: Page, host: str, tree: mapped.Mapped, least: float) -> list[str]:
    """The texts that the tree leaves of a page."""
    blocks = [(k, x) for k, x in page.texts() if not page.away[k]]
    marked = [(k, x) for k, x in blocks if page.inside[k]]
    chosen = marked or blocks
    if not chosen:
        return []
    limit = REPEATED if marked else least
    nodes = page.keys(host)
    texts = [nodes[k] ^ _hash("c", x) for k, x in chosen]
    keys = np.array([*nodes, *texts], np.uint64)
    worth, known = tree.get(keys, "importance", 1.0), tree.get(keys, "pages", 0)
    hint = np.array([x == HINT for x in page.hints])
    # outside an article a weak word stands unless enough pages speak against it
    cut = (worth[: len(nodes)] < np.where(hint, limit * 2, limit)) | (hint & (known[: len(nodes)] < ENOUGH) & (not marked))
    cut[0] = False
    cut = cut.tolist()
    for k in range(1, len(nodes)):
        cut[k] = cut[k] or cut[page.parents[k]]
    low = [cut[k] or w < REPEATED for (k, _), w in zip(chosen, worth[len(nodes) :])]
    kept = [x for (_, x), cut in zip(chosen, low) if not cut]
    if marked and 2 * sum(map(len, kept)) <= sum(len(x) for _, x in chosen):
        return [x for _, x in chosen]
    return kept


def extract(pages: DataFrame, least: float = LEAST) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""
    # a branch of importance is only looked at where a class word may be overruled
    held = written(importances(pages).filter((F.col("importance") < 2 * least) | (F.col("pages") >= ENOUGH)), "branches")
    tree = mapped.build(held, held.count(), "cut-branches", {"importance": "f8", "pages": "i8"})

    def work(batches):
        for batch in batches:
            texts = ["\n".join(_kept(Page(source or ""), host_of(url), tree, least)) for url, source in _rows(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(lean(work), "page_id long, url string, text string, n_chars long")


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
