"""Stored web pages: texts and attributes of chosen elements, in one reading of each page.

Pages stay where they are: a step holds one page's events at a time, and nothing is shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field
from html.entities import html5
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Elements without an end tag, and elements whose text is no text of the page.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset("script style template".split())
_UNFINISHED = re.compile("<[a-zA-Z/!?]")
_NAMED = re.compile("&([a-zA-Z][a-zA-Z0-9]*;?)")


@dataclass(frozen=True)
class Pick:
    """Elements of a page, in the order of their start tags.

    ``tag`` None: any.  Elements must have all classes of ``cls`` and none of ``but``, and the attributes of
    ``attrs`` (value None: with any value); ``inside`` names elements that must be open around them.  ``take`` is
    an attribute's name or ``text``, ``prefix`` goes before it; elements without the attribute don't count.  Of
    what is found, every ``step``-th from ``start`` on is kept.
    """

    tag: str | None = None
    cls: tuple[str, ...] = ()
    but: tuple[str, ...] = ()
    attrs: dict[str, str | None] = field(default_factory=dict)
    inside: tuple[str, ...] = ()
    take: str = "text"
    prefix: str = ""
    start: int = 0
    step: int = 1

    def fits(self, tag: str, attrs: dict[str, str], around: Counter) -> bool:
        classes = attrs.get("class", "").split()
        return (
            self.tag in (None, tag)
            and all(c in classes for c in self.cls)
            and not any(c in classes for c in self.but)
            and all(k in attrs and v in (None, attrs[k]) for k, v in self.attrs.items())
            and all(around[t] for t in self.inside)
            and (self.take == "text" or self.take in attrs)
        )


def _only(bare: tuple[str, ...], page: str) -> str:
    """``page`` with the ampersand escaped of each named reference that has no semicolon and doesn't begin with a name of ``bare``."""
    return _NAMED.sub(lambda m: m[0] if m[1].startswith(bare) or (m[1][-1] == ";" and m[1] in html5) else f"&amp;{m[1]}", page)


class _Page(HTMLParser):
    """A page's text in pieces, and for each pick the values found: attributes, or ranges of pieces.

    An end tag closes the nearest open element of its name and all that was opened since; one that closes nothing
    is passed over, and what is open at the end of the page ends there.  A tag or comment that the page's end cuts
    short is dropped.
    """

    def __init__(self, picks: tuple[Pick, ...], page: str, bare: tuple[str, ...] | None = None):
        super().__init__(convert_charrefs=True)
        self.picks, self.pieces, self.found = picks, [], [[] for _ in picks]
        self.stack, self.open = [], Counter()
        self.feed(page if bare is None else _only(bare, page))
        if not _UNFINISHED.match(self.rawdata):
            self.close()
        while self.stack:
            self._end()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        values = {}
        for name, value in attrs:
            values.setdefault(name, value or "")  # of a repeated attribute the first counts
        ranges = []
        for pick, found in zip(self.picks, self.found, strict=True):
            if pick.fits(tag, values, self.open):
                found.append(values[pick.take] if pick.take != "text" else [len(self.pieces), None])
                if pick.take == "text":
                    ranges.append(found[-1])
        if tag == "br":
            self.pieces.append(" ")
        self.stack.append((tag, ranges))
        self.open[tag] += 1
        if tag in VOID:
            self._end()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if self.open[tag]:
            while self._end() != tag:
                pass

    def handle_data(self, data: str) -> None:
        if not any(self.open[t] for t in HIDDEN):
            self.pieces.append(data)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """``<![...>`` is a comment, whatever it names."""
        return self.parse_bogus_comment(i, report)

    def _end(self) -> str:
        tag, ranges = self.stack.pop()
        self.open[tag] -= 1
        for r in ranges:
            r[1] = len(self.pieces)
        return tag

    def column(self, i: int) -> list[str]:
        p = self.picks[i]
        values = self.found[i][p.start :: p.step]
        return [p.prefix + (v if isinstance(v, str) else "".join(self.pieces[v[0] : v[1]])) for v in values]


def _per_page(returns: str, read: Callable[[str], object]) -> Callable[[Column], Column]:
    """``read`` for every page but null.  Rows go to Python a hundred at a time: pages are large, and an Arrow batch holds ten thousand."""
    return F.udf(lambda page: None if page is None else read(page), returns, useArrow=False)


def element_text(html: Column, bare: tuple[str, ...] | None = None) -> Column:
    """All text of a page or fragment with references decoded and a space for each line break; null for null.

    Scripts, styles, templates and comments have no text.  ``bare``: names of the references that count without their
    semicolon; None: all that HTML lists.
    """
    return _per_page("string", lambda page: "".join(_Page((), page, bare).pieces))(html)


def extract_listing(pages: DataFrame, id_col: str, html: str, picks: dict[str, Pick], bare: tuple[str, ...] | None = None) -> DataFrame:
    """(id, pos, a column for each pick): the n-th finds of all picks side by side, up to the shortest; ``bare`` as in ``element_text``.

    Each page is read once for all columns.  Null or empty pages, pages where a pick finds nothing, and no picks
    give no rows; rows with equal ids each have their own positions, and other columns of ``pages`` are left alone.
    """
    names, chosen = tuple(picks), tuple(picks.values())

    def read(page: str) -> list[list[str]]:
        parsed = _Page(chosen, page, bare)
        return [list(values) for values in zip(*(parsed.column(i) for i in range(len(chosen))), strict=False)]

    rows = pages.select(F.col(id_col), F.posexplode(_per_page("array<array<string>>", read)(F.col(html))).alias("pos", "_values"))
    return rows.select(id_col, "pos", *[F.get("_values", F.lit(i)).alias(name) for i, name in enumerate(names)])
