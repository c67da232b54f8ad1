"""Main text of HTML pages by a site style tree.

All pages of a host are merged into one tree whose nodes are element paths with their
classes.  A node's importance mixes two entropies: how varied the child sequences are
with which pages present it, and how varied the texts below it are (a text that returns
on page after page carries nothing).  A block stays if the least important node of its
branch reaches what the block needs.  What it needs depends on what is known beforehand:
a block outside a page's ``article`` or ``main`` needs more, so does one that a class
name calls a menu, advert, comment or the like.  Elements that HTML itself sets aside
(``nav``, ``footer``, ``form``, ``script``, ...) go always.
"""

from __future__ import annotations

import html as entities
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import cache, lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _common as common

#: Possessive throughout: where a tag has no end, the rest of the page is a tag cut off, so reading stays linear.
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+)>""")
ATTRIBUTE = re.compile(r"""([^\s=/"'<>]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?""")
#: Attributes that say something about an element's part in the page.
TELLING = re.compile(r"class|\bid\b|role|hidden|style", re.I)
WORDS = re.compile(r"[a-z]+")

# Elements of HTML by their part in the page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
ASIDE = frozenset(
    "nav footer aside form menu dialog head script style noscript template iframe button select textarea title svg object canvas audio video "
    "fieldset input datalist math map".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar note".split())
# Words of class names: the first call a part by what it is, the others only say where or how large it is.
NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs masthead banner footer sidebar aside ad ads advert adverts advertisement advertising "
    "sponsor sponsored promo cookie cookies consent gdpr notice notices popup modal newsletter subscribe signup share sharing social related "
    "comment comments disqus respond replies form search login widget pagination toolbar skip".split()
)
PLACES = frozenset("area bar block body bottom box container content global inner item items left list main outer page post right section site top wrap wrapper".split())
#: What a new element of a kind ends, and where the search for it stops.
ENDS = {"li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "option": ("option", "select datalist")}
ENDS |= {"tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table")}
ENDS |= {k: ("tr td th thead tbody tfoot", "table") for k in ("thead", "tbody", "tfoot")}
ENDS = {k: (ends.split(), stops.split()) for k, (ends, stops) in ENDS.items()}
AROUND = "article section div td th li aside nav header footer main form table body".split()

GAMMA = 0.9
#: Importance that any block needs; that a block needs besides outside a page's article; by a name, inside one and elsewhere.
LEAST, OUTSIDE, NAMED_INSIDE, NAMED = 0.3, 0.35, 0.35, 0.75
#: Nodes on fewer pages than this can't show their importance, which counts as UNPROVED then.
PAGES, UNPROVED = 3, 0.5
#: Elements nested deeper belong to the last of so many, as in browsers.
DEPTH = 512


def _named(names: str) -> bool:
    """Whether some class name or id consists of words for a part beside the article, apart from words for places."""
    words = (WORDS.findall(x) for x in names.split())
    return any(not NAMES.isdisjoint(x) and NAMES.union(PLACES).issuperset(x) for x in words)


@lru_cache(1 << 15)
def described(parent: int, tag: str, attributes: str) -> tuple[int, bool, bool, bool, bool]:
    """An element's node, whether it is an article, is set aside, is called something beside the article, is called a header."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    names, role = found.get("class", "").lower(), found.get("role", "").lower()
    key = xxhash.xxh64_intdigest(f"{parent}>{tag}.{'.'.join(sorted(names.split()))}") >> 1
    aside = tag in ASIDE or role in ROLES or "hidden" in found or found.get("aria-hidden") == "true"
    aside = aside or "display:none" in found.get("style", "").replace(" ", "").lower()
    main, told = tag in ("article", "main") or role in ("main", "article"), f"{names} {found.get('id', '').lower()}"
    return key, main, aside, tag not in ("html", "body") and not main and _named(told), "header" in WORDS.findall(told)


@cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}[\s/>]", re.I)


class Page:
    """The text blocks of a page that HTML doesn't set aside: (text, node, inside an article, named, importance of the branch)."""

    def __init__(self, source: str, importance: dict[int, float] | None = None):
        self.importance = importance or {}
        self.blocks: list[tuple[str, int, bool, bool, float]] = []
        self.paths: dict[int, tuple[int, ...]] = {}
        self.children: dict[int, array] = {}
        # (tag, node, inside, aside, named, importance of the branch, whether the article's own importance is low)
        self.stack: list[tuple[str, int, bool, bool, bool, float, bool]] = [("", 0, False, False, False, 1.0, False)]
        self.places: dict[str, list[int]] = {}
        self.text: list[str] = []
        self._read(source)

    def _flush(self) -> None:
        if self.text:
            raw = "".join(self.text)
            self.text = []
            _, node, inside, aside, named, least, _ = self.stack[-1]
            if not aside and raw and not raw.isspace():
                text = " ".join((entities.unescape(raw) if "&" in raw else raw).split())
                if text:
                    self.blocks.append((text, node, inside, named, least))
                    if node not in self.paths:
                        self.paths[node] = tuple(x[1] for x in self.stack[1:])

    def _pop_to(self, at: int) -> None:
        if any(x[0] in BLOCK for x in self.stack[at:]):
            self._flush()
        while len(self.stack) > at:
            self.places[self.stack.pop()[0]].pop()

    def _end(self, tags: list[str], stops: list[str]) -> None:
        """Close the innermost open element of ``tags``, unless one of ``stops`` comes first."""
        at = max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)
        if at and all(self.places[t][-1] <= at for t in stops if self.places.get(t)):
            self._pop_to(at)

    def _open(self, tag: str, attributes: str, closed: bool) -> None:
        if tag == "br":
            self.text.append(" ")
            return
        if tag in BLOCK:
            self._flush()
            if self.places.get("p"):
                self._end(["p"], [*AROUND, "blockquote", "button"])
        if tag in ENDS:
            self._end(*ENDS[tag])
        _, parent, inside, aside, named, least, free = self.stack[-1]
        key, main, own_aside, own_named, header = described(parent, tag, attributes if TELLING.search(attributes) else "")
        self.children.setdefault(parent, array("Q")).append(key)
        if tag in VOID or len(self.stack) > DEPTH or (closed and tag in ("svg", "math")):
            return
        own = self.importance.get(key, UNPROVED)
        if main and not inside:
            # a wrapper's name doesn't set aside the article in it; an article that returns as a whole is no template
            named, least, free = False, 1.0, own < LEAST
        elif not free:
            least = min(least, own)
        aside = aside or own_aside or (not inside and tag == "header")
        named = named or own_named or (not inside and header and not main)
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, key, inside or main, aside, named, least, free))

    def _read(self, source: str) -> None:
        done = at = 0  # up to ``done`` all is read; from ``at`` on the next tag is looked for
        while (at := source.find("<", at)) >= 0:
            ahead = source[at + 1 : at + 4]
            if ahead[:1] in ("!", "?"):
                self.text.append(source[done:at])
                mark, start = ("-->", at + 4) if ahead == "!--" else (">", at)
                end = source.find(mark, start)
                done = at = end + len(mark) if end >= 0 else len(source)
                continue
            m = TAG.match(source, at)
            if m is None:
                if ahead.lstrip("/")[:1].isalpha():
                    break  # a tag cut off at the end of the page
                at += 1
                continue
            self.text.append(source[done:at])
            done = at = m.end()
            tag = m[2].lower()
            if m[1]:
                self._end([tag], AROUND if tag == "p" or tag not in BLOCK else [])
                if tag in BLOCK:
                    self._flush()
            elif tag in RAW:
                # its content is no markup, up to its own end tag
                close = _raw_end(tag).search(source, at)
                stop = source.find(">", close.start()) if close else -1
                done = at = stop + 1 if stop >= 0 else len(source)
            else:
                self._open(tag, m[3], m[3].endswith("/"))
        self.text.append(source[done : at if at >= 0 else len(source)])
        self._flush()


def page_features(page: Page) -> Iterator[tuple[int, int, int]]:
    """(node, kind, feature) of a page, each once: kind 0 for a node's own texts, 1 for its children's sequence, 2 for its being there."""
    seen = {(node, 0, xxhash.xxh64_intdigest(text) >> 1) for text, node, _, _, _ in page.blocks}
    seen.update((node, 2, 0) for node in page.paths)
    seen.update((node, 1, xxhash.xxh64_intdigest(children.tobytes()) >> 1) for node, children in page.children.items() if node)
    return iter(seen)


def host_of(url: str):
    return common.lower_ascii(F.coalesce(F.regexp_extract(F.col(url), r"://([^/?#]*)", 1), F.lit("")))


def importance(rows: DataFrame) -> DataFrame:
    """(host, node, pages, importance) from (host, html): the merged tree of all pages.

    Importance is ``(1 - GAMMA) * presentation + GAMMA * content``.  Presentation: the entropy of
    the child sequences over the pages that present the node, relative to its largest
    value.  Content: one less the mean relative logarithm of the number of pages on which the
    texts below it occur.  Sums are taken over (host, node, feature) first, so a host
    with most of the pages is spread over its features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            paths: dict[int, tuple[int, ...]] = {}
            for host, source in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                page = Page(source)
                paths |= page.paths
                counts.update((host, *x) for x in page_features(page))
            out = [list(c) for c in zip(*[(*k, n) for k, n in counts.items()], strict=True)] or [[], [], [], [], []]
            out.append([paths[k[1]] if k[2] == 2 else None for k in counts])
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["host", "node", "kind", "feature", "c", "path"])

    features = rows.mapInArrow(run, "host string, node long, kind int, feature long, c long, path array<long>")
    counts = features.groupBy("host", "node", "kind", "feature").agg(F.sum("c").alias("c"), F.first("path").alias("path"))
    text, style = F.col("kind") == 0, F.col("kind") == 1
    c = F.col("c").cast("double")
    own = common.cut(
        counts.groupBy("host", "node").agg(
            F.sum(F.when(style, c)).alias("presented"),
            F.sum(F.when(style, c * F.log(c))).alias("c_log_c"),
            F.max(F.when(F.col("kind") == 2, c)).alias("there"),
            F.sum(F.when(text, F.log(c))).alias("log_c"),
            F.count(F.when(text, 1)).alias("texts"),
            F.first("path", ignorenulls=True).alias("path"),
        )
    )
    # what is known of a node's texts holds for all nodes above it, too
    below = own.filter("texts > 0").select("host", F.explode("path").alias("node"), "log_c", "texts")
    below = below.groupBy("host", "node").agg(F.sum("log_c").alias("log_c"), F.sum("texts").alias("texts"))
    by = own.drop("log_c", "texts", "path").join(below, ["host", "node"])
    pages = F.greatest(F.coalesce("presented", F.lit(0.0)), F.coalesce("there", F.lit(0.0)))
    scale = F.when(pages > 1, F.log(pages))
    content = 1 - F.coalesce(F.col("log_c") / F.col("texts") / scale, F.lit(0.0))
    presentation = F.coalesce((F.log("presented") - F.col("c_log_c") / F.col("presented")) / scale, content)
    return by.select("host", "node", pages.alias("pages"), ((1 - GAMMA) * presentation + GAMMA * content).alias("importance"))


def extract(pages: DataFrame, support: int = PAGES, url_col: str = "url", html_col: str = "html", id_col: str = "page_id") -> DataFrame:
    """The main text of every page: page_id, url, text, one row per input row.

    Blocks come in page order, joined by one newline; white space inside a block is one
    space; character references are decoded.  A block stays if no node of its branch is
    less important on its host than the block needs; nodes on fewer than ``support``
    pages count as UNPROVED.  The branch of a block in an ``article`` or ``main`` begins below that, and if the
    article itself returns on page after page, all of it stays.  If nothing
    would be left, all unnamed blocks stay, or else all.  Null html: empty text.  Null
    URLs form one host.  Repeated rows come out alike; an empty table gives no rows;
    other columns are ignored.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host_of(url_col).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html")
    )
    proved = importance(rows.select("host", "html")).filter(F.col("pages") >= support)
    one = F.struct("node", F.col("importance").cast("float").alias("value"))
    tree = proved.groupBy("host").agg(F.collect_list(one).alias("tree"))
    tree = tree.select("host", F.col("tree.node").alias("nodes"), F.col("tree.value").alias("marks"))
    # written first, so that its true size decides how it joins
    joined = rows.join(common.cut(tree), "host", "left").select("page_id", "url", "html", "host", "nodes", "marks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees: dict[str, dict[int, float]] = {}
            texts = []
            for i, (source, host) in enumerate(zip(batch[2].to_pylist(), batch[3].to_pylist(), strict=True)):
                if host not in trees:
                    trees[host] = dict(zip(batch[4][i].as_py() or (), batch[5][i].as_py() or (), strict=True))
                texts.append("\n".join(main_blocks(Page(source, trees[host]))))
            yield pa.RecordBatch.from_arrays([batch[0], batch[1], pa.array(texts, pa.string())], ["page_id", "url", "text"])

    kind = joined.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string")


def main_blocks(page: Page) -> list[str]:
    article = any(inside and not named for _, _, inside, named, _ in page.blocks)

    def needed(inside: bool, named: bool) -> float:
        return LEAST + (OUTSIDE if article and not inside else 0) + (named and (NAMED_INSIDE if inside else NAMED))

    found = [text for text, _, inside, named, least in page.blocks if least >= needed(inside, named)]
    return found or [x[0] for x in page.blocks if not x[3]] or [x[0] for x in page.blocks]
