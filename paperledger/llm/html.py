"""Main text of web pages: site templates found by counting element subtrees per host, and deleted.

Each page is parsed where it lies. Of its elements outside the article, and of containers inside it (`CONTAINERS`), a hash of the
subtree (tag, class, id, text, children) is counted per host, over pages that differ. A subtree on at least `MIN_PAGES` pages
and `MIN_SHARE` percent of a host's pages is template and deleted, as are elements that name themselves no content: menus,
headers, footers, sidebars, notices, adverts, forms, comments, scripts and styles. What is left of the article (`article`,
else `main`, else the body) gives its blocks.

Inside an article paragraphs and headings outside containers stay, since texts may share them. Of several articles on a page
those that recur are teasers, unless all do. An article that would keep nothing but headings keeps its containers.

A name is a whole class or id, or the last word of a compound (`post-comments`, `ad-container`) if the element holds no h1,
article or main. An element around an article goes by its class, id or role only if an unnamed article as long lies elsewhere,
one around a main never. Inside an article headers and headings stay whatever their name.

Counts are combined before the shuffle; a page joins its host's templates through its own hashes, so a hot host is spread.

A null html is an empty page and gives an empty text, as does one without an article's text. A null url has host ''. Rows
that repeat are extracted each; copies of one page count once for their host. Parsing never fails and knows no depth limit.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from paperledger.llm.frames import as_text, numbers
from paperledger.session import shared_dir

MIN_PAGES = 5
MIN_SHARE = 5

# Elements of HTML by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th "
    "thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("body caption html legend li optgroup option tbody td tfoot th thead tr dd dt".split()) | {"li", "dd", "dt"}
CLOSED_BY_SAME = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
SCOPES = frozenset("table td th ul ol dl article section main div body html button object aside nav header footer form".split())

# Names that say an element is no content.
DROPPED = frozenset(
    "aside audio button canvas datalist dialog embed footer form head iframe input math menu nav noscript object script search select "
    "style svg template textarea title video".split()
)
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
DROPPED_NAMES = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie "
    "cookies disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices overlay "
    "pagination paywall popup promo promotion recommended related respond search share sharing sidebar signup skip social sponsor "
    "sponsored subscribe subscription toolbar topbar widget widgets".split()
)
KEPT = frozenset("html body main article".split())
# Words of a compound name that say it is a box, and those that say what an element has or lacks.
BOX_WORDS = frozenset(
    "area articles bar block body box button buttons container content form icons inner items link links list module outer panel posts row section "
    "slot stories unit wrap wrapper".split()
)
STATES = frozenset("category has hide is no not show tag type with without".split())
# Elements that are counted inside an article or main.
CONTAINERS = frozenset("article details div dl figure ol section table ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 header hgroup".split())


class Page(HTMLParser):
    """Elements in order of their start: tag, attributes, parent, and items (text, or the place of a child)."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.tags, self.attrs, self.parents, self.items = ["#root"], [{}], [-1], [[]]
        self.open = [0]
        self.depths: dict[str, list[int]] = {}  # places of a tag's open elements in `open`
        self.feed(html)
        self.close()

    def _close(self, tags: frozenset | set, scopes: frozenset | set) -> None:
        """Closes the innermost of these elements, and what is open inside it, unless a scope is in between."""
        depth = max((self.depths[t][-1] for t in tags if t in self.depths), default=0)
        if not depth or any(self.depths[t][-1] > depth for t in scopes if t in self.depths):
            return
        for at in self.open[depth:]:
            places = self.depths[self.tags[at]]
            places.pop()
            if not places:
                del self.depths[self.tags[at]]
        del self.open[depth:]

    def parse_html_declaration(self, i: int) -> int:
        """A marked section is a comment up to its end; the library raises at those it does not know."""
        if self.rawdata.startswith("<![CDATA[", i):
            end = self.rawdata.find("]]>", i)
            if end >= 0:
                return end + 3
        if self.rawdata.startswith("<![", i):
            return self.parse_bogus_comment(i, report=0)
        return super().parse_html_declaration(i)

    def parse_starttag(self, i: int) -> int:
        # Without an end in sight the library reads all of the rest, again for each tag.
        return super().parse_starttag(i) if self.rawdata.find(">", i) >= 0 else -1

    def parse_comment(self, i: int, report: int = 1) -> int:
        return super().parse_comment(i, report) if self.rawdata.find("--", i + 4) >= 0 and self.rawdata.find(">", i) >= 0 else -1

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSES_P:
            self._close({"p"}, SCOPES)
        if tag in CLOSED_BY_SAME:
            for _ in range(2):
                self._close(CLOSED_BY_SAME[tag], SCOPES - {"td", "th"} if tag not in ("li", "dt", "dd", "option") else SCOPES)
        at = len(self.tags)
        self.items[self.open[-1]].append(at)
        self.tags.append(tag)
        self.attrs.append({k: v or "" for k, v in attrs})
        self.parents.append(self.open[-1])
        self.items.append([])
        if tag not in VOID:
            self.depths.setdefault(tag, []).append(len(self.open))
            self.open.append(at)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("body", "html") or tag in VOID:
            return
        self._close({tag}, frozenset() if tag in BLOCKS else BLOCKS)

    def handle_data(self, data: str) -> None:
        self.items[self.open[-1]].append(data)

    def names_no_content(self, at: int) -> bool:
        tag, attrs = self.tags[at], self.attrs[at]
        if tag in DROPPED and not (tag == "form" and self.around[at]):
            return True
        if tag in KEPT and tag != "article":
            return False
        if tag == "article":
            return self._named(at) and self._spare(at)
        if tag == "header" and not self.inside[at] and not self.around[at]:
            return True
        if "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attrs.get("style", "")):
            return True
        if tag in HEADINGS and self.inside[at]:
            return False
        named = self._named(at) or attrs.get("role", "").lower() in DROPPED_ROLES
        return named and (not self.around[at] or self._spare(at))

    def _named(self, at: int) -> bool:
        """Whether a whole class or id is a dropped name, or a compound ends in one and the element is a small box."""
        for name in ("class", "id"):
            for token in self.attrs[at].get(name, "").lower().split():
                if token in DROPPED_NAMES:
                    if token != "header" or not self.inside[at]:
                        return True
                    continue
                words = re.findall(r"[a-z]+", token)
                if len(words) < 2 or words[0] in STATES:
                    continue
                while len(words) > 1 and words[-1] in BOX_WORDS:
                    words.pop()
                if words[-1] not in DROPPED_NAMES or words[-1] == "widget" or self.tags[at] == "article" or self.around[at]:
                    continue
                if words[-1] == "header" and (self.inside[at] or self.headed[at]) or self.titled[at]:
                    continue
                return True
        return False

    def _spare(self, at: int) -> bool:
        """Whether a named article, or a named box around articles, can go: an article without a name is elsewhere, for a box one as long."""
        if self.unnamed is None:
            size = [sum(len("".join(x.split())) for x in items if isinstance(x, str)) for items in self.items]
            self.longest, held = [0] * len(self.tags), [False] * len(self.tags)
            for x in range(len(self.tags) - 1, 0, -1):
                size[self.parents[x]] += size[x]
                own = size[x] if self.tags[x] == "article" else 0
                self.longest[x] = max(self.longest[x], own)
                self.longest[self.parents[x]] = max(self.longest[self.parents[x]], self.longest[x])
            self.unnamed = -1
            for x in range(1, len(self.tags)):
                tag = self.tags[x]
                named = tag in DROPPED - {"form"} or self._named(x) or self.attrs[x].get("role", "").lower() in DROPPED_ROLES
                held[x] = held[self.parents[x]] or named and tag not in ("html", "body", "main")
                if tag == "article" and not held[x]:
                    self.unnamed = max(self.unnamed, size[x])
        if self.tags[at] == "article":
            return self.unnamed >= 0
        return not self.has_main[at] and self.unnamed >= self.longest[at]

    def marked(self) -> Page:
        """Adds for each element `inside` and `around` (an article or main), `dropped` (by name, itself or around it), `boxed`
        (in a container inside an article), and whether it holds a main, an h1 or any heading."""
        self.inside, self.around, self.dropped, self.boxed = ([False] * len(self.tags) for _ in range(4))
        self.has_main, self.titled, self.headed = ([False] * len(self.tags) for _ in range(3))
        self.unnamed: int | None = None
        for at in range(len(self.tags) - 1, 0, -1):
            tag, parent = self.tags[at], self.parents[at]
            self.around[parent] |= self.around[at] or tag in ("article", "main")
            self.has_main[parent] |= self.has_main[at] or tag == "main"
            self.titled[parent] |= self.titled[at] or tag == "h1"
            self.headed[parent] |= self.headed[at] or tag in HEADINGS
        for at in range(1, len(self.tags)):
            self.inside[at] = self.inside[self.parents[at]] or self.tags[at] in ("article", "main")
        for at in range(1, len(self.tags)):
            self.dropped[at] = self.dropped[self.parents[at]] or self.names_no_content(at)
        self.articles = self._outermost("article", self.dropped)
        whole = set(self.articles) if len(self.articles) < 2 else set()
        for at in range(1, len(self.tags)):
            self.boxed[at] = self.boxed[self.parents[at]] or self.inside[at] and self.tags[at] in CONTAINERS and at not in whole
        return self

    def hashes(self) -> list[int]:
        """A hash of each element's subtree, without what is dropped by name; 0 around an article, and in it outside containers.

        Children come after their parent, so one pass from the end sees them first.
        """
        out = [0] * len(self.tags)
        for at in range(len(self.tags) - 1, 0, -1):
            if self.dropped[at] or (not self.boxed[at] if self.inside[at] else self.around[at]):
                continue
            h = hashlib.blake2b(digest_size=8)
            attrs = self.attrs[at]
            h.update(f"{self.tags[at]}\x1f{attrs.get('class', '')}\x1f{attrs.get('id', '')}".encode("utf-8", "replace"))
            for item in self.items[at]:
                h.update(b"\x1e" + (out[item].to_bytes(8, "little", signed=True) if isinstance(item, int) else " ".join(item.split()).encode("utf-8", "replace")))
            out[at] = int.from_bytes(h.digest(), "little", signed=True)
        return out

    def main_text(self, template: frozenset | set) -> str:
        hashes = self.hashes() if template else []
        found = [bool(template) and self._counted(at) and hashes[at] in template for at in range(len(self.tags))]
        if self.articles and all(found[at] for at in self.articles):
            for at in self.articles:
                found[at] = False
        gone = self._gone(found)
        roots = self._roots(gone)
        if any(found[at] and self.inside[at] for at in range(len(found))) and not self._has_text(roots, gone):
            # Nothing but headings would be left: what recurs is this page's content.
            gone = self._gone([f and not self.inside[at] for at, f in enumerate(found)])
            roots = self._roots(gone)
        blocks, text = [], []

        def flush() -> None:
            block = " ".join("".join(text).split())
            if block:
                blocks.append(block)
            text.clear()

        for root in roots:
            todo: list = [root]
            while todo:
                item = todo.pop()
                if isinstance(item, str):
                    text.append(item)
                elif item is None:
                    flush()
                elif gone[item]:
                    if self.tags[item] in BLOCKS:
                        flush()
                else:
                    tag = self.tags[item]
                    if tag == "br":
                        text.append(" ")
                    if tag in BLOCKS:
                        flush()
                        todo.append(None)
                    todo.extend(reversed(self.items[item]))
            flush()
        return "\n\n".join(blocks)

    def _gone(self, found: list[bool]) -> list[bool]:
        gone = list(self.dropped)
        for at in range(1, len(self.tags)):
            gone[at] = gone[at] or found[at] or gone[self.parents[at]]
        return gone

    def _roots(self, gone: list[bool]) -> list[int]:
        return self._outermost("article", gone) or self._outermost("main", gone) or [0]

    def _has_text(self, roots: list[int], gone: list[bool]) -> bool:
        """Whether any text outside headings is left."""
        todo = list(roots)
        while todo:
            at = todo.pop()
            if gone[at] or self.tags[at] in HEADINGS:
                continue
            if any(isinstance(x, str) and x.strip() for x in self.items[at]):
                return True
            todo.extend(x for x in self.items[at] if isinstance(x, int))
        return False

    def _outermost(self, tag: str, gone: list[bool]) -> list[int]:
        found, within = [], [False] * len(self.tags)
        for at in range(1, len(self.tags)):
            own = self.tags[at] == tag and not gone[at]
            if own and not within[self.parents[at]]:
                found.append(at)
            within[at] = own or within[self.parents[at]]
        return found

    def _counted(self, at: int) -> bool:
        """Whether the element can be template: inside an article or main only containers, as texts may share paragraphs."""
        if self.dropped[at] or not self.items[at]:
            return False
        if self.inside[at]:
            return self.boxed[at] and self.tags[at] in CONTAINERS
        return not self.around[at] and self.tags[at] not in KEPT and self.tags[at] not in ("head", "br")

    def candidates(self) -> set[int]:
        hashes = self.hashes()
        return {hashes[at] for at in range(1, len(self.tags)) if self._counted(at)}


_CONTAINER = re.compile(rf"(?i)<(?:{'|'.join(sorted(CONTAINERS))}|main)\b")


def page(html: str | None) -> Page:
    return Page(html or "").marked()


def without_article(html: str) -> str:
    """The page with its article emptied, if it has just one and that no container: what is inside is no candidate, and most of the page."""
    if len(re.findall(r"(?i)<article\b", html)) == 1 and len(re.findall(r"(?i)</article\s*>", html)) == 1:
        found = re.search(r"(?is)(<article\b[^>]*>)(.*)(</article\s*>)", html)
        if found and not _CONTAINER.search(found[2]):
            return html[: found.end(1)] + html[found.start(3):]
    return html


def keyed(pages: DataFrame) -> DataFrame:
    """The columns needed, with `host` and `page`, a digest of the html."""
    host = F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"(?i)^\s*[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    rows = pages.select(as_text("page_id"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.withColumn("host", F.lower(host)).withColumn("page", F.md5(F.coalesce("html", F.lit(""))))


def subtrees(pages: DataFrame) -> DataFrame:
    """host, page (a digest), subtree for each candidate of each page; subtree null once for each page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hosts, digests, found = [], [], []
            for host, digest, html in zip(batch["host"], batch["page"], batch["html"]):
                own = [None, *page(without_article(html or "")).candidates()]
                hosts += [host] * len(own)
                digests += [digest] * len(own)
                found += own
            yield pd.DataFrame({"host": hosts, "page": digests, "subtree": pd.array(found, "Int64")})

    return keyed(pages).select("host", "page", "html").mapInPandas(run, "host string, page string, subtree long").distinct()


def templates(found: DataFrame, min_pages: int, min_share: int) -> DataFrame:
    """host, subtree of those that recur."""
    counts = found.groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("n"))
    pages = counts.filter("subtree IS NULL").select(F.col("host").alias("_host"), F.col("n").alias("pages"))
    many = counts.filter(F.col("subtree").isNotNull() & (F.col("n") >= min_pages)).join(pages, F.col("host") == F.col("_host"))
    return many.filter(100 * F.col("n") >= min_share * F.col("pages")).select("host", "subtree")


def main_texts(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: int = MIN_SHARE) -> DataFrame:
    """page_id, url, text, n_chars for each row of pages."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [page(html).main_text(set(gone) if gone is not None else set()) for html, gone in zip(batch["html"], batch["gone"])]
            yield pd.DataFrame({
                "page_id": numbers(batch["page_id"]), "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    # Kept, as three branches below read it: a few short rows for each page.
    shared_dir(pages.sparkSession)
    found = subtrees(pages).checkpoint()
    gone = found.join(templates(found, min_pages, min_share), ["host", "subtree"]).groupBy("host", "page").agg(F.collect_set("subtree").alias("gone"))
    rows = keyed(pages)
    return rows.join(gone, ["host", "page"], "left").select("page_id", "url", "html", "gone").mapInPandas(
        run, "page_id long, url string, text string, n_chars long")
