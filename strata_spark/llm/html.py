"""Main text of web pages by consensus of each host's pages.

Every page scores its containers by the running text they hold, less what is boilerplate. Votes for
generalised tag-class paths are added up per host, and all pages of a host are extracted by the winning path;
a page without it is extracted by its own best one. Inside it, text goes only where a tag or a whole name says that it is
none of the article's; names that merely begin like such a one lose votes, not text.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import add_columns, slices, staged, unused

#: Fixed values of HTML: elements without content, with skipped content, those of them that go on to the page's end
#: if they aren't closed, what a head holds, and elements that don't end a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg select object".split())
SWALLOWS = frozenset("script style title textarea".split())
HEAD = frozenset("base link meta noscript script style template title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: An open element that a new one of these ends.
ENDED_BY = {"p": frozenset("p div ul ol dl table h1 h2 h3 h4 h5 h6 article section aside nav footer header form pre blockquote hr main figure li".split()), "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
#: Elements that hold no main text. An article's own header does.
BOILERPLATE_TAGS = frozenset("nav header footer aside form button menu dialog head".split())
#: Whole names (one of the classes, the id or the role) of what holds no main text.
BOILERPLATE_NAMES = frozenset("""ad ads ad-box ad-banner ad-container ad-slot ad-unit ad-wrapper advert adverts advertisement advertisements advertising adsbygoogle banner ad-label
alert-banner breadcrumb breadcrumbs comment comments comment-list comment-form comment-section comments-area comments-list comments-section post-comments reader-comments disqus disqus_thread respond reply replies
complementary consent consent-banner contentinfo cookie cookies cookie-banner cookie-bar cookie-consent cookie-notice gdpr footer footer-nav page-footer site-footer header page-header site-header masthead navigation nav navbar navigation-menu nav-menu
menu main-menu main-nav site-nav topbar top-bar newsletter newsletter-signup notice notices pagination pager popup modal promo promotion promotions related related-articles related-links related-posts search search-form
share share-bar share-buttons share-links sharing social social-bar social-icons social-links social-media social-share sidebar side-bar left-sidebar right-sidebar sidebar-left sidebar-right signup sign-up skip skip-link sponsor sponsored sponsors
subscribe subscription toolbar widget widgets widget-area""".split())
#: A name that begins like these loses its container's votes, but no text.
SUSPECT = re.compile(r"(?i)(?:^|\s)(?:ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|gdpr|header|menu|masthead|nav|navbar|newsletter|notices?|pagination|popup|promo|related|reply|replies|share|sharing|side-?bar|signup|skip|social|sponsor\w*|subscribe|toolbar|widget)(?:$|[\s_-])")
#: Elements whose names only describe the page's layout; the words don't count there.
LAYOUT_TAGS = frozenset("html body main article".split())
#: Votes of containers whose tag says what they are count so many times.
TAG_WEIGHT = {"article": 4, "main": 3, "body": 1, "html": 1}
#: Winning paths of so many hosts are broadcast; with more hosts, pages and paths are joined by shuffling.
BROADCAST_HOSTS = 50_000

BY_TAG = 1 << 40
#: Paths of more characters are shown by a hash; their depth is kept beside.
PATH_CHARS = 300

_START = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][a-zA-Z0-9:-]*))")
_STOP = re.compile(r"[>\"']")
#: One attribute: its name, and its value in quotes or plain.
_ATTRIBUTE = re.compile(r"""([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")


def attributes_of(source: str) -> dict[str, str]:
    """Attributes of a start tag by lower-case name; of repeated ones the first. What stands in quotes is no attribute."""
    out: dict[str, str] = {}
    for name, double, single, plain in _ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), double or single or plain)
    return out


@dataclass
class _Open:
    tag: str
    dropped: int  # how many containers are dropped by their names here, and BY_TAG for each that is by its tag or hidden
    number: int
    suspect: int = 0


@dataclass
class Page:
    """Containers by number, the page being 0: their tags, paths, depths, parents and how many more suspect names
    stand at or around them than around the least suspect text. Blocks as (text, number of the innermost container, dropped, characters in links)."""

    tags: list = field(default_factory=lambda: [""])
    depths: list = field(default_factory=lambda: [0])
    suspect: list = field(default_factory=lambda: [0])
    paths: list = field(default_factory=lambda: [""])
    parents: list = field(default_factory=lambda: [0])
    blocks: list = field(default_factory=list)


class _Tags:
    """The tags of a page, in one pass: each place is looked at a bounded number of times, whatever isn't closed."""

    def __init__(self, source: str):
        self.source, self.quotes = source, True

    def next(self, at: int):
        """(start, end, closing, tag, attributes) of the next tag or, with an empty tag, comment or declaration; None if there is none."""
        source = self.source
        m = _START.search(source, at)
        if not m:
            return None
        if m[0] == "<!--":
            end = source.find("-->", m.end())
            return m.start(), len(source) if end < 0 else end + 3, False, "", ""
        end = source.find(">", m.end()) if not m[2] else self._end(m.end())
        if end < 0:
            return None
        return m.start(), end + 1, bool(m[1]), (m[2] or "").lower(), source[m.end() : end] if m[2] else ""

    def _end(self, at: int) -> int:
        """The end of a tag; quotes that open an attribute's value hide it. Once one isn't closed, quotes are plain."""
        source, first = self.source, at
        while self.quotes and (m := _STOP.search(source, at)):
            at = m.end()
            if m[0] == ">":
                return m.start()
            before = m.start() - 1
            while before > first and source[before].isspace():
                before -= 1
            if source[before] == "=":
                at = source.find(m[0], at) + 1
                if not at:
                    self.quotes = False
        return source.find(">", first)


def _ends(source: str, tag: str) -> dict[int, int]:
    """Where each element of a tag ends, by the place after its start tag; those that aren't closed are left out."""
    tags, at, opened, out = _Tags(source), 0, [], {}
    while found := tags.next(at):
        _, at, closing, name, attributes = found
        closed = attributes.endswith("/")
        if name == tag and closing:
            if opened:
                out[opened.pop()] = at
        elif name == tag and not (closed and tag == "svg"):
            opened.append(at)
        elif name in SWALLOWS and not closing and not (closed and opened):
            at = _raw_end(source, at, name)
    return out


def _raw_end(source: str, at: int, tag: str) -> int:
    end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(source, at)
    return end.end() if end else len(source)


def parse(source: str | None) -> Page:
    """One pass over tags; unclosed and unexpected tags are taken as browsers mostly do.

    Where names would drop all that a page has, what the fewest of them drop is kept; likewise with suspect names.
    """
    page, stack = Page(), [_Open("", 0, 0)]
    open_tags: dict[str, int] = {}
    text: list[str] = []
    linked, in_link, at, source = 0, 0, 0, source or ""
    ends: dict[str, dict[int, int]] = {}
    tags = _Tags(source)

    def close_block():
        nonlocal linked
        words = " ".join(entities.unescape("".join(text)).split())
        if words:
            page.blocks.append((words, stack[-1].number, stack[-1].dropped, linked))
        text.clear()
        linked = 0

    def close_element():
        tag = stack.pop().tag
        open_tags[tag] -= 1
        return tag

    def add(s: str):
        nonlocal linked
        if stack[-1].tag == "head" and s.strip():
            close_element()
        text.append(s)
        if in_link:
            linked += len(s)

    while at < len(source):
        found = tags.next(at)
        if not found:
            cut = re.compile(r"<(?:/?[a-zA-Z]|!)").search(source, max(at, source.rfind(">") + 1))  # a tag that the page's end cuts off
            add(source[at : cut.start()] if cut else source[at:])
            break
        start, end, closing, tag, attributes = found
        if start > at:
            add(source[at:start])
        at = end
        if not tag:
            continue
        if closing:
            if tag in INLINE:
                in_link = max(0, in_link - (tag == "a"))
                continue
            close_block()
            if open_tags.get(tag):
                while close_element() != tag:
                    pass
                in_link = 0
            continue
        if stack[-1].tag == "head" and tag not in HEAD:
            close_element()
        if tag in SWALLOWS:
            at = _raw_end(source, at, tag)
            continue
        if tag in RAW:
            if not (tag == "svg" and attributes.endswith("/")):
                if tag not in ends:
                    ends[tag] = _ends(source, tag)
                at = ends[tag].get(at, at)
            continue
        if tag in INLINE:
            in_link += tag == "a"
            if tag == "br":
                text.append(" ")
            continue
        close_block()
        in_link = 0
        for depth in range(len(stack) - 1, 0, -1):
            if tag in ENDED_BY.get(stack[depth].tag, ()):
                while len(stack) > depth:
                    close_element()
                break
            if stack[depth].tag not in ENDED_BY:
                break
        if tag in VOID:
            continue
        names = attributes_of(attributes)
        marks = " ".join((names.get("class", ""), names.get("id", ""), names.get("role", "")))
        own_header = tag == "header" and open_tags.get("article")
        dropped = BY_TAG if tag in BOILERPLATE_TAGS and not own_header or "hidden" in names else int(tag not in LAYOUT_TAGS and not own_header and not BOILERPLATE_NAMES.isdisjoint(marks.lower().split()))
        suspect = stack[-1].suspect + int(tag not in LAYOUT_TAGS and not own_header and bool(SUSPECT.search(marks)))
        first = re.sub(r"\d+", "#", names.get("class", "").split()[0]) if names.get("class", "").strip() else ""
        path = f"{page.paths[stack[-1].number]}/{tag}" + f".{first}" * bool(first)
        page.tags.append(tag)
        page.parents.append(stack[-1].number)
        page.depths.append(page.depths[stack[-1].number] + 1)
        page.suspect.append(suspect)
        page.paths.append(path if len(path) <= PATH_CHARS else "#" + hashlib.md5(path.encode("utf-8", "surrogatepass")).hexdigest())
        open_tags[tag] = open_tags.get(tag, 0) + 1
        stack.append(_Open(tag, stack[-1].dropped + dropped, len(page.tags) - 1, suspect))
    close_block()
    least = min((dropped for _, _, dropped, _ in page.blocks), default=0)
    page.blocks = [(words, inside, dropped > least % BY_TAG or dropped >= BY_TAG, linked) for words, inside, dropped, linked in page.blocks]
    least = min((page.suspect[inside] for _, inside, dropped, _ in page.blocks if not dropped), default=0)
    page.suspect = [max(0, n - least) for n in page.suspect]
    return page


def votes(page: Page) -> dict[str, tuple[int, int]]:
    """Characters of running text less twice those of boilerplate and links, and the depth, by path; only positive ones.

    Text under a suspect name counts for no container.
    """
    worth, out = [0] * len(page.tags), {}
    for words, inside, dropped, linked in page.blocks:
        worth[inside] += -2 * len(words) if dropped else 0 if page.suspect[inside] else len(words) - 3 * min(linked, len(words))
    for k in range(len(page.tags) - 1, 0, -1):  # containers come after those that hold them
        worth[page.parents[k]] += worth[k]
        tag = page.tags[k]
        if not page.suspect[k] and tag not in ENDED_BY and not re.fullmatch(r"h[1-6]|blockquote|pre|ul|ol|dl", tag):
            out[page.paths[k]] = out.get(page.paths[k], (0, 0))[0] + worth[k] * TAG_WEIGHT.get(tag, 2), page.depths[k]
    return {p: v for p, v in out.items() if v[0] > 0}


def best(by_path: dict[str, tuple[int, int]]) -> str | None:
    """The path with most votes; of equal ones the deepest, then the first in order."""
    return min(by_path, key=lambda p: (-by_path[p][0], -by_path[p][1], p), default=None)


def main_text(source: str | None, path: str | None) -> str:
    """The blocks of the containers of a path, or of the page's own best path if it has none there; or of the page, if it has no containers."""
    page = parse(source)
    found = _within(page, path)
    if not found:
        own = best(votes(page))
        found = [w for w, _, dropped, _ in page.blocks if not dropped] if own is None else _within(page, own)
    return "\n".join(found)


def _within(page: Page, path: str | None) -> list[str]:
    """The blocks that aren't dropped, of the containers of a path."""
    inside = [False] * len(page.tags)
    for k in range(1, len(page.tags)):
        inside[k] = inside[page.parents[k]] or page.paths[k] == path
    return [w for w, k, dropped, _ in page.blocks if inside[k] and not dropped]


def host(url: Column) -> Column:
    """Lower-case host of a URL, without its port; empty for null and other strings."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def extract(pages: DataFrame, html: str = "html", url: str = "url", broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """Adds text (the main text, blocks joined by a line feed, or empty) and n_chars to pages.

    Null html has empty text; a null or odd url belongs to the host ""; ties go to the deeper path and then to the
    first in order; repeated rows vote each; other columns stay, whatever their names; an empty table gives an empty table. Columns of these names are replaced.
    Votes are partial sums per host and path, so a host with very many pages is no group in one task.
    """
    def vote(batches):
        import pyarrow as pa

        for batch in slices(batches, "html"):
            total: dict = {}
            for h, source in zip(batch.column("h").to_pylist(), batch.column("html").to_pylist(), strict=True):
                for path, (v, depth) in votes(parse(source)).items():
                    total[h, path, depth] = total.get((h, path, depth), 0) + v
            columns = [*zip(*total)] or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int32()), pa.array(total.values(), pa.int64())], ["h", "path", "depth", "votes"])

    sums = pages.select(host(F.col(url)).alias("h"), F.col(html).alias("html")).mapInArrow(vote, "h string, path string, depth int, votes long").groupBy("h", "path", "depth").agg(F.sum("votes").alias("votes"))
    first = F.min(F.struct((-F.col("votes")).alias("votes"), (-F.col("depth")).alias("above"), "path"))
    at, to = unused(pages, "host"), unused(pages, "path")
    winners = staged(sums.groupBy("h").agg(first.alias("w")).select(F.col("h").alias(at), F.col("w.path").alias(to)), "paths")
    small = winners.count() <= broadcast_hosts
    joined = pages.withColumn(at, host(F.col(url))).join(F.broadcast(winners) if small else winners, at, "left")

    def make(batch):
        import pyarrow as pa

        texts = [main_text(s, p) for s, p in zip(batch.column(html).to_pylist(), batch.column(to).to_pylist(), strict=True)]
        return [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]

    return add_columns(joined, html, "text string, n_chars long", make, whole=True).drop(at, to)
