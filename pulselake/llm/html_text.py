"""Main text of web pages by consensus of each host's pages.

Every page scores its containers by the text that stands in them and names the best one by its
generalised path: the tags from the root down, each with its classes, digits blotted out. Spark
counts these votes per host. The pages are then read again, and the text is taken from the
container on the path that won its host, or from the page's own best where it has none there.
A page votes for the article, main or content container around its best container, so that
leads, headings and sections beside the longest block come along.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.llm.common import bounded_batches
from pulselake.session import stage

# What HTML's tags mean here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NOISE_TAGS = frozenset(
    "nav header footer aside form script style noscript iframe button select option textarea template svg math "
    "head title menu dialog object embed audio video canvas fieldset label input datalist".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section select summary table tbody td tfoot th thead title tr ul caption".split()
)
CONTAINERS = frozenset("article main section div td body blockquote center".split())
#: An opening tag closes these open ones, up to the nearest of the second set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Words of a class or id that mark what isn't the article, and words that speak against it.
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promotion "
    "sidebar side rail menu nav navbar navigation breadcrumb breadcrumbs topbar toolbar header masthead footer "
    "bottombar cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended recommendations comment comments "
    "commentlist disqus reply replies respond discussion pagination pager widget widgets hidden paywall "
    "disclaimer copyright kommentar kommentare kommentarer leserkommentare commentaire commentaires comentario "
    "comentarios commenti reacties opinions".split()
)
#: Words before a noise word that only tell how a page is laid out, as in ``with-sidebar``.
LAYOUT_WORDS = frozenset("with has no without".split())
GOOD_WORDS = frozenset("article content main post entry body story text page blog".split())
#: Those of them that name a whole article; the others also name parts of one or the whole page.
CONTENT_WORDS = frozenset("article content main post entry story".split())
#: What a new block's end of a paragraph, and an end tag, don't reach through; end tags that do.
PARAGRAPH_STOPS = CONTAINERS | {"th", "li", "button", "table"}
CLOSE_STOPS = frozenset("article main body table".split())
CLOSE_THROUGH = CLOSE_STOPS | {"html", "div", "section"}
#: Factors of a container's score.
BONUS = {"article": 1.6, "main": 1.4, "body": 0.5, "td": 0.8, "blockquote": 0.5, "center": 0.8}

TAG = re.compile(r"<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)")
TAG_EVENT = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=/\"'>]+)")
NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
DIGITS = re.compile(r"\d+")


class Element:
    __slots__ = ("tag", "step", "mark", "noise", "parent", "home", "score", "factor", "content", "chars", "links")

    def __init__(
        self, tag: str, step: str, noise: bool, parent: Element | None, factor: float, content: bool = False
    ) -> None:
        self.tag, self.step, self.noise, self.parent, self.factor = tag, step, noise, parent, factor
        self.mark = path_mark(parent.mark, step) if parent else 0  # stands for the path, in this process
        self.home = self if parent is None or tag in CONTAINERS else parent.home  # the nearest container
        self.content = content  # an article, main or content container
        self.score = 0.0
        self.chars = self.links = 0  # of its blocks: characters, and those in links

    @property
    def above(self) -> Element | None:
        """The container around this one."""
        return self.parent.home if self.parent else None

    @property
    def path(self) -> str:
        steps, at = [], self
        while at is not None:
            steps.append(at.step)
            at = at.parent
        return ">".join(reversed(steps))


def path_mark(above: int, step: str) -> int:
    return hash((above, step))


class Tags:
    """Finds where tags end, in time that grows with the page however many tags are left open."""

    def __init__(self, source: str) -> None:
        self.source = source
        self.last = {quote: source.rfind(quote) for quote in "\"'"}
        self.event = self.close = (0, 0)  # the stretch known to hold none, and the next one
        self.hopeless: set[int] = set()  # opening quotes from which no end is found

    def _event(self, at: int) -> int:
        if not self.event[0] <= at <= self.event[1]:
            m = TAG_EVENT.search(self.source, at)
            self.event = (at, m.start() if m else len(self.source))
        return self.event[1]

    def _close(self, at: int) -> int:
        if not self.close[0] <= at <= self.close[1]:
            found = self.source.find(">", at)
            self.close = (at, found if found >= 0 else len(self.source))
        return self.close[1]

    def end(self, at: int) -> int:
        """Place of the ``>`` that ends a tag; past the page's end if there is none.

        Quotes are skipped. If a quote is never closed, or no ``>`` follows, the next ``>`` counts.
        """
        start, met = at, []
        while True:
            at = self._event(at)
            if at < len(self.source) and self.source[at] == ">":
                return at
            if at == len(self.source) or at in self.hopeless or self.last[self.source[at]] == at:
                self.hopeless.update(met)
                return self._close(start)
            met.append(at)
            at = self.source.index(self.source[at], at + 1) + 1


class Page:
    """Blocks and containers of one page; tolerant of unclosed and stray tags."""

    def __init__(self, source: str) -> None:
        root = Element("", "", False, None, 0.4)
        self.open = [root]
        self.places: dict[str, list[int]] = {}  # where in ``open`` elements of a tag stand
        self.containers = [root]
        self.blocks: list[tuple[Element, str]] = []  # innermost container, text
        self.parts: list[str] = []
        self.linked = 0
        self.link_chars: list[int] = []
        self._read(source or "")
        self._end_block()

    def _read(self, source: str) -> None:
        n = len(source)
        tags = Tags(source)
        told = at = 0  # all before ``told`` has been read
        while (at := source.find("<", at)) >= 0:
            if source.startswith("<!--", at):
                end = source.find("-->", at + 4)
                end = n if end < 0 else end + 3
                name = data = None
            elif source.startswith("<![CDATA[", at):
                stop = source.find("]]>", at + 9)
                name, data = None, source[at + 9 : n if stop < 0 else stop]
                end = n if stop < 0 else stop + 3
            elif source.startswith(("<!", "<?"), at):
                end = source.find(">", at)
                end = n if end < 0 else end + 1
                name = data = None
            else:
                name = TAG.match(source, at)
                end = tags.end(name.end()) + 1 if name else n + 1
                if end > n:  # no tag: the sign is text
                    at += 1
                    continue
            if at > told:
                self._text(source[told:at])
            told = at = end
            if name is None:
                if data:
                    self.parts.append(data)
                continue
            tag = name["tag"].lower()
            if name["end"]:
                self._close(tag)
                continue
            attrs = source[name.end() : end - 1]
            self._start(tag, attrs)
            if tag in RAW and not attrs.endswith("/"):
                stop = re.compile(f"</{re.escape(tag)}", re.I).search(source, at)
                shut = source.find(">", stop.end()) if stop else -1
                told = at = n if shut < 0 else shut + 1
                self._close(tag)
        if told < n:
            self._text(source[told:])

    def _text(self, raw: str) -> None:
        if self.open[-1].noise:
            return
        text = entities.unescape(raw) if "&" in raw else raw
        self.parts.append(text)
        if self.linked:
            self.link_chars.append(len(text.strip()))

    def _end_block(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                at = self.open[-1].home
                self.blocks.append((at, text))
                linked = sum(self.link_chars)
                at.chars += len(text)
                at.links += linked
                weight = max(0, len(text) - 2 * linked)
                share = 1.0
                while at is not None and share > 0.1:
                    at.score += weight * share
                    share /= 2
                    at = at.above
            self.parts = []
        self.link_chars = []

    def _last(self, tags) -> int:
        """Place of the innermost open element with one of these tags, 0 if none."""
        return max((self.places[tag][-1] for tag in tags if self.places.get(tag)), default=0)

    def _push(self, element: Element) -> None:
        self.places.setdefault(element.tag, []).append(len(self.open))
        self.open.append(element)

    def _cut(self, place: int) -> None:
        for element in self.open[place:]:
            self.places[element.tag].pop()
        del self.open[place:]

    def _start(self, tag: str, attrs: str) -> None:
        if tag == "br":
            self.parts.append(" ")
            return
        if tag in BLOCKS:
            self._end_block()
            self._close_paragraph()
        if tag in CLOSES:
            ends, stops = CLOSES[tag]
            if self._last(ends) > self._last(stops):
                self._cut(self._last(ends))
        if tag in VOID:
            return
        if tag == "a":
            self.linked += 1
        if tag not in BLOCKS and tag not in NOISE_TAGS and not attrs:
            return  # plain inline markup changes nothing
        above = self.open[-1]
        classes, words, hidden, named_noise = self._attributes(attrs)
        noise = above.noise or tag in NOISE_TAGS or hidden
        noise = noise or (named_noise and tag not in ("article", "main", "body", "html"))
        if tag not in BLOCKS and not noise:
            return
        factor = BONUS.get(tag, 1.0) * (1.3 if words & GOOD_WORDS and tag not in ("body", "html") else 1.0)
        content = tag in ("article", "main") or (tag in CONTAINERS and tag != "body" and bool(words & CONTENT_WORDS))
        element = Element(tag, tag + classes, noise, above, factor, content)
        if tag not in BLOCKS:
            self._end_inline()
        self._push(element)
        if tag in CONTAINERS and not noise:
            self.containers.append(element)

    def _end_inline(self) -> None:
        self.parts.append(" ")

    def _close_paragraph(self) -> None:
        place = self._last(("p",))
        if place > self._last(PARAGRAPH_STOPS):
            self._cut(place)

    def _close(self, tag: str) -> None:
        if tag == "a":
            self.linked = max(0, self.linked - 1)
        if tag in BLOCKS:
            self._end_block()
        place = self._last((tag,))
        # An end tag without a start inside the nearest container is stray.
        if place and (tag in CLOSE_THROUGH or place > self._last(CLOSE_STOPS)):
            self._cut(place)

    @staticmethod
    def _attributes(attrs: str) -> tuple[str, frozenset, bool, bool]:
        """Classes as a part of the path, all words, whether hidden, whether named as noise.

        A name with a good word is noise only if it begins with a noise word (``related-content``,
        but not ``article-header``), and another name that is all good overrules it.
        """
        if not attrs.strip(" /\n\t\r"):
            return "", frozenset(), False, False
        found = {}
        for m in ATTRIBUTE.finditer(attrs):
            name = (m[1] or m[5]).lower()
            found.setdefault(name, next((x for x in m.groups()[1:4] if x is not None), ""))
        classes = sorted(set(DIGITS.sub("#", entities.unescape(found.get("class", ""))).replace(">", "").split()))
        words: set[str] = set()
        noise = good = False
        for name in " ".join((found.get("class", ""), found.get("id", ""), found.get("role", ""))).split():
            own = [w.lower() for w in NAMES.findall(name)]
            words.update(own)
            if not own or own[0] in LAYOUT_WORDS:
                continue
            if NOISE_WORDS.isdisjoint(own):
                good = good or not GOOD_WORDS.isdisjoint(own)
            elif own[0] in NOISE_WORDS or GOOD_WORDS.isdisjoint(own):
                noise = True
        style = found.get("style", "").replace(" ", "").lower()
        hidden = "hidden" in found or "display:none" in style or found.get("aria-hidden", "").lower() == "true"
        hidden = hidden or found.get("role", "").lower() in ("navigation", "banner", "contentinfo", "complementary", "alert", "dialog", "search")
        return "".join(f".{c}" for c in classes), frozenset(words), hidden, noise and not good

    def best(self) -> Element | None:
        """The container with the highest score; of equals the outermost, then the first."""
        top = None
        for element in self.containers:
            value = element.score * element.factor
            if value > 0 and (top is None or value > top.score * top.factor):
                top = element
        return top

    def chosen(self) -> Element | None:
        """The article, main or content container around the best one, or the best one itself.

        An article is as far as it goes, and all its text belongs to it. Another container is
        taken if what it adds isn't mostly links.
        """
        top = self.best()
        whole = {id(e): [e.chars, e.links] for e in self.containers}
        for e in reversed(self.containers):  # inner ones stand after outer ones
            if e.above is not None:
                chars, links = whole[id(e)]
                whole[id(e.above)][0] += chars
                whole[id(e.above)][1] += links
        around = top
        while top is not None and top.tag != "article" and around is not None:
            around = around.above
            if around is None or not around.content:
                continue
            added, linked = (a - b for a, b in zip(whole[id(around)], whole[id(top)]))
            if around.tag == "article" or 2 * linked <= added:
                top = around
        return top

    def text(self, path: str | None) -> str:
        """Text of the containers on ``path``, or of the page's own choice if there is none."""
        out = self._below(self._on(path)) if path else []
        if not out:
            top = self.chosen()
            out = self._below({id(top)}) if top is not None else [t for _, t in self.blocks]
        return "\n\n".join(out)

    def _on(self, path: str) -> set[int]:
        mark = 0
        for step in path.split(">")[1:]:
            mark = path_mark(mark, step)
        return {id(e) for e in self.containers if e.mark == mark}

    def _below(self, chosen: set[int]) -> list[str]:
        """Texts of the blocks that stand in one of the containers."""
        inside: set[int] = set()
        for e in self.containers:  # outer ones stand before inner ones
            if id(e) in chosen or (e.above is not None and id(e.above) in inside):
                inside.add(id(e))
        return [text for home, text in self.blocks if id(home) in inside]


def host(url_column: str = "url") -> Column:
    """Lower-cased host of a URL, empty if it has none."""
    found = F.regexp_extract(F.col(url_column), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(found, F.lit("")))


def _vote_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tally: dict[tuple[str, str], list] = {}
        for name, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            top = Page(source).chosen()
            if top is not None:
                votes = tally.setdefault((name, top.path), [0, 0])
                votes[0] += 1
                votes[1] += int(top.score)
        rows = [(h, p, v, s) for (h, p), (v, s) in tally.items()]
        yield pa.RecordBatch.from_pylist(
            [{"host": h, "path": p, "votes": v, "chars": s} for h, p, v, s in rows],
            pa.schema([("host", pa.string()), ("path", pa.string()), ("votes", pa.int64()), ("chars", pa.int64())]),
        )


def winning_paths(pages: DataFrame) -> DataFrame:
    """w_host, path: on each host the path that most pages voted for; of equals the one with more text."""
    bounded_batches(pages.sparkSession)
    votes = pages.select(host().alias("host"), "html").mapInArrow(
        _vote_batches, "host string, path string, votes long, chars long"
    )
    sums = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("chars").alias("chars"))
    return sums.groupBy(F.col("host").alias("w_host")).agg(F.max_by("path", F.struct("votes", "chars", "path")).alias("path"))


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Null and empty html, and pages without text outside menus and the like, give an empty text. Pages without
    a readable URL vote together. Headings inside the article belong to it. White space is
    Unicode's. A tag whose quote is never closed ends at the next ``>``; a ``<`` that no ``>`` follows is
    text. Pages of any length, depth and state take time that grows with their length. Repeated rows stay rows, an empty table gives none; other columns are ignored.
    """
    bounded_batches(pages.sparkSession)
    rows = pages.select("page_id", "url", "html", host().alias("host"))
    # A table of its own, whose size the planner knows: pages are only shuffled if it is large.
    winners = stage(winning_paths(pages.select("url", "html")), "host-paths")
    joined = rows.join(winners, F.col("host") == F.col("w_host"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(h).text(p) for h, p in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.select("page_id", "url", "html", "path").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars long"
    )
