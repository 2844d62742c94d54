"""Main text of web pages by composite text density.

A page becomes a tree (implied end tags, void and raw-text elements as in HTML).
Every node gets its characters per tag, lowered by the share of its characters
and tags that lie in links (composite text density), and the sum of its
children's densities.  The node with the largest sum holds the article; the
threshold is half the smallest link-free density on the path from the body down
to it.  Where the article is spread over siblings, the root moves up as long as
another child reaches the threshold with running text of its own, and of the
children joined in this way those under the threshold are left out.

Elements that are never article text (scripts, navigation, forms, ...) and
those whose class, id or role says so (adverts, sidebars, notices, reader
comments) are cut before densities are computed.  Such a name alone does not cut
an element that holds the page's heading, main element or article, nor a
heading.  Inside an article or main element only names of adverts, notices,
comments and sidebars cut by themselves, also with a word for their container or place
(``ad-slot``, ``user-comments``).  Other names there, and names of which only a part is
such a word (``related-work``), cut if half of the element's text is links.

Text is taken block by block in page order: character references decoded, white
space runs to one space, trimmed, empty blocks left out, blocks joined by one
newline; a ``br`` is white space.  Null and empty pages, and pages without text,
give an empty string.  Nesting of any depth is handled without recursion.  Other
columns pass through; repeated rows are extracted alike.
"""

from __future__ import annotations

import html
import math
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CUT = frozenset(
    "head script style noscript template svg canvas iframe object embed applet audio video map nav footer aside form button select "
    "option textarea input label dialog menu title noembed noframes".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Names (whole words of class and id) that mark page furniture.
FURNITURE = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense banner banners breadcrumb breadcrumbs byline comment comments commentlist "
    "consent cookie cookies copyright disclaimer disqus dropdown footer gdpr header login masthead menu menubar meta modal nav navbar navigation "
    "newsletter notice notices notification overlay pager pagination paywall popup promo promos promotion related replies reply respond "
    "rss search share sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription tags teaser toolbar topbar widget widgets".split()
)
# Of these, the names that cut inside an article too, alone or with words that name a container or a place.
SURE = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense comment comments commentlist consent cookie cookies disqus gdpr "
    "notice notices paywall popup promo promos promotion replies reply respond sidebar sidebars sponsor sponsored".split()
)
CONTAINERS = frozenset(
    "area bar block body bottom box card cell column container content count entry feed form group inner item items left list main outer page panel "
    "place post posts primary reader readers right row secondary section site slot sticky thread title top unit user users widget wrap wrapper zone".split()
)
# What stands beside an article when it is called related.
RELATED_TO = frozenset("articles content links news pages posts reading reads stories story topics videos".split())
COMMENTS = frozenset("comment comments commentlist disqus replies reply respond".split())
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
# An element of the first kind that opens closes an open one of the second.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"}, "option": {"option"},
}
KEEPS = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}}
CLOSES_P = BLOCK - frozenset("body html td th tr tbody thead tfoot caption option legend summary".split())

TOKEN = re.compile(
    r"""<!--(?P<c>.*?)(?:--!?>|\Z)|<[!?][^>]*>|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?>=\s*(?:"[^"]*"|'[^']*')|[^>])*+)>|<(?=/?[a-zA-Z])[^>]*+(?:>|\Z)|(?P<text>[^<]+|<)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
NAMES = re.compile(r"[a-z]+")
HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?(?:false|until))|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)


def surely_furniture(words: set[str]) -> bool:
    """Whether the words of one class or id name an advert, a notice, comments, a sidebar or related posts, whatever holds it.

    ``user-comments``, ``ad-slot`` or ``adslot`` do; ``related-work`` and ``ad-hoc`` do not.
    """
    words = {w for w in words if len(w) > 1}
    if "related" in words and words & RELATED_TO:
        return words <= RELATED_TO | CONTAINERS | {"related"}
    sure = {w for w in words if w in SURE or any((w.startswith(s) and w[len(s) :] in CONTAINERS) or (w.endswith(s) and w[: -len(s)] in CONTAINERS) for s in SURE)}
    return bool(sure) and words - sure <= CONTAINERS


class Page:
    """A page as arrays: of each node its tag, parent and furniture mark; the items are nodes' starts and texts in order."""

    def __init__(self, source: str):
        self.tag, self.parent, self.mark, self.items = ["#"], [-1], [""], []
        self.end = [0]
        stack = [0]
        at, n = 0, len(source)
        lowered = None
        while at < n:
            m = TOKEN.match(source, at)
            at = m.end()
            if (text := m["text"]) is not None:
                self.items.append((stack[-1], html.unescape(text) if "&" in text else text))
                continue
            if m["tag"] is None:
                continue
            tag = m["tag"].lower()
            if m["end"]:
                self._close(stack, tag)
                continue
            if tag in ("html", "body") and tag in self.tag[:8]:
                continue
            self._implied(stack, tag)
            attrs = m["attrs"]
            node = len(self.tag)
            self.tag.append(tag)
            self.parent.append(stack[-1])
            self.mark.append(self._furniture(tag, attrs) if attrs else "")
            self.items.append((node, None))
            if tag in RAW:
                if lowered is None:
                    lowered = source.lower() if source.isascii() else re.sub("[A-Z]", lambda x: x[0].lower(), source)
                close = lowered.find("</" + tag, at)
                if close < 0:
                    at = n
                else:
                    stop = source.find(">", close)
                    at = n if stop < 0 else stop + 1
            elif tag not in VOID and not attrs.endswith("/"):
                stack.append(node)
            elif tag not in VOID:
                # "<div/>" opens a div; other names close themselves as in XML
                if tag in BLOCK:
                    stack.append(node)

    @staticmethod
    def _furniture(tag: str, attrs: str) -> str:
        """Why the attributes mark furniture: "always", "name" (adverts, notices, comments), "outside" an article, or "links" decide."""
        if tag in ("html", "body"):
            return ""
        found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attrs)}
        whole = [set(NAMES.findall(t)) for t in f"{found.get('class', '')} {found.get('id', '')}".lower().split()]
        names = set().union(*whole)
        if tag in ("article", "main"):
            return "always" if names & COMMENTS else ""
        if found.get("role", "").lower() in ROLES or HIDDEN.search(attrs):
            return "always"
        if tag in HEADINGS:
            return ""
        if any(surely_furniture(t) for t in whole):
            return "name"
        if not names & FURNITURE:
            return ""
        return "outside" if any(t and t <= FURNITURE for t in whole) else "links"

    def _implied(self, stack: list[int], tag: str) -> None:
        if tag in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                name = self.tag[stack[k]]
                if name == "p":
                    del stack[k:]
                    break
                if name in BLOCK:
                    break
        if tag in CLOSES:
            for k in range(len(stack) - 1, 0, -1):
                name = self.tag[stack[k]]
                if name in KEEPS[tag]:
                    break
                if name in CLOSES[tag]:
                    del stack[k:]
                    if name == tag or tag in ("dt", "dd", "td", "th"):
                        break

    def _close(self, stack: list[int], tag: str) -> None:
        inline = tag == "p" or tag not in BLOCK
        for k in range(len(stack) - 1, 0, -1):
            name = self.tag[stack[k]]
            if name == tag:
                del stack[k:]
                return
            if inline and name in BLOCK:
                return

    def _mostly_links(self) -> list[bool]:
        """Whether at least half of a node's text lies in links."""
        n = len(self.tag)
        chars, links, in_link = [0] * n, [0] * n, [False] * n
        for k in range(1, n):
            in_link[k] = in_link[self.parent[k]] or self.tag[k] == "a"
        for node, text in self.items:
            if text is not None:
                size = sum(map(len, text.split()))
                chars[node] += size
                links[node] += size * in_link[node]
        for k in range(n - 1, 0, -1):
            chars[self.parent[k]] += chars[k]
            links[self.parent[k]] += links[k]
        return [0 < c <= 2 * a for c, a in zip(chars, links)]

    def cut(self) -> list[bool]:
        """Whether a node is not article text, by its own tag and names or by a node above it."""
        n = len(self.tag)
        keeps = [False] * n  # holds the heading, the main element or an article
        for k in range(n - 1, 0, -1):
            if self.tag[k] in ("h1", "main", "article") and not self.mark[k]:
                keeps[k] = True
            keeps[self.parent[k]] = keeps[self.parent[k]] or keeps[k]
        linked = self._mostly_links() if "outside" in self.mark or "links" in self.mark else []
        out, inside = [False] * n, [False] * n  # inside: in an article or main
        in_header = [False] * n
        for k in range(1, n):
            up, tag = self.parent[k], self.tag[k]
            inside[k] = inside[up] or tag in ("article", "main")
            in_header[k] = in_header[up] or tag == "header"
            mark = self.mark[k]
            named = mark in ("always", "name") or (mark == "outside" and not inside[k]) or (mark in ("outside", "links") and linked[k])
            named = named and not (keeps[k] and tag not in HEADINGS)
            out[k] = out[up] or tag in CUT or named
            if tag == "header" and not keeps[k] and not inside[k]:
                out[k] = True
        # of a header, only what its headings hold, and only where it belongs to the article
        heading = [False] * n
        for k in range(1, n):
            heading[k] = heading[self.parent[k]] or self.tag[k] in HEADINGS
        self.no_text = [out[k] or (in_header[k] and not heading[k]) for k in range(n)]
        return out


def densities(page: Page, cut: list[bool]) -> tuple[list[float], list[float], list[int], list[int], list[int]]:
    """Composite density, sum of the children's densities, characters, link characters and tags of every node."""
    n = len(page.tag)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    linked = [False] * n
    for k in range(1, n):
        linked[k] = linked[page.parent[k]] or page.tag[k] == "a"
    for node, text in page.items:
        if text is not None and not page.no_text[node]:
            size = sum(map(len, text.split()))
            chars[node] += size
            if linked[node]:
                link_chars[node] += size
    for k in range(n - 1, 0, -1):
        up = page.parent[k]
        if not cut[k]:
            chars[up] += chars[k]
            link_chars[up] += link_chars[k]
            tags[up] += tags[k] + 1
            link_tags[up] += link_tags[k] + (page.tag[k] == "a")
    share = link_chars[0] / max(1, chars[0])
    density, total = [0.0] * n, [0.0] * n
    for k in range(n - 1, -1, -1):
        c, t, lc, lt = chars[k], max(1, tags[k]), link_chars[k], link_tags[k]
        if c and not cut[k]:
            base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
            density[k] = c / t * max(0.0, math.log(c / max(1, lc) * t / max(1, lt)) / base) if base > 0 else 0.0
        if k:
            total[page.parent[k]] += density[k]
    return density, total, chars, link_chars, tags


def main_text(source: str | None) -> str:
    """The article of a page, its blocks joined by newlines."""
    if not source:
        return ""
    page = Page(source)
    cut = page.cut()
    density, total, chars, links, tags = densities(page, cut)
    n = len(page.tag)
    if not chars[0]:
        return ""
    body = next((k for k in range(n) if page.tag[k] == "body"), 0)
    root = max(range(n), key=lambda k: (total[k], -k))
    if total[root] <= 0:
        root = body
    path = [root]
    while page.parent[path[-1]] >= 0:
        path.append(page.parent[path[-1]])
    on_path = path[: path.index(body) + 1] if body in path else path
    # of siblings only the link-free characters per tag count: the composite density also grows with a node's size
    plain = {k: (chars[k] - links[k]) / max(1, tags[k]) for k in range(n) if not cut[k]}
    threshold = min(plain[k] for k in on_path if k in plain) / 2
    children: dict[int, list[int]] = {}
    for k in range(1, n):
        if not cut[k]:
            children.setdefault(page.parent[k], []).append(k)

    def running(k: int) -> bool:
        return plain[k] >= threshold and links[k] * 3 <= chars[k]

    # the article element around the root, else upwards over siblings that read like text
    named = next((k for k in on_path if page.tag[k] == "article"), None)
    left_out: set[int] = set()
    if named is not None:
        root = named
    else:
        for up in path[1:]:
            if up == 0 or page.tag[up] == "html":
                break
            others = [k for k in children.get(up, []) if k != root]
            if not any(running(k) and page.tag[k] not in HEADINGS for k in others):
                # a heading right before the article belongs to it
                if not any(page.tag[k] == "h1" for k in others):
                    if page.tag[up] in ("main", "article") or len(others) == 0:
                        root = up
                        continue
                    break
            # between parts of the article short siblings are parts of it, unless they are links
            joined = [root, *(k for k in others if running(k))]
            between = {k for k in others if min(joined) < k < max(joined) and links[k] * 3 <= chars[k]}
            left_out |= {k for k in others if not running(k) and k not in between and page.tag[k] not in HEADINGS and page.tag[k] != "p"}
            root = up
    return _blocks(page, root, left_out)


def _blocks(page: Page, root: int, left_out: set[int]) -> str:
    n = len(page.tag)
    inside, block = [False] * n, [0] * n  # block: the nearest block element
    inside[root] = True
    for k in range(n):
        up = page.parent[k]
        if k != root and up >= 0:
            inside[k] = inside[up] and not page.no_text[k] and k not in left_out
            # a header's own text is left out, its headings are not
            inside[k] = inside[k] or (inside[up] and page.tag[k] in HEADINGS and not page.no_text[k])
        block[k] = k if page.tag[k] in BLOCK or up < 0 else block[up]
    reach = [False] * n  # below the root, whether or not text is taken there
    reach[root] = True
    for k in range(root + 1, n):
        reach[k] = reach[page.parent[k]] and k not in left_out
    out: list[str] = []
    part: list[str] = []
    at = None
    for node, text in page.items:
        if not reach[node]:
            continue
        if text is None:
            if block[node] == node and part:  # a block opens
                out.append("".join(part))
                part = []
            elif page.tag[node] == "br":
                part.append(" ")
            continue
        if block[node] != at:
            if part:
                out.append("".join(part))
                part = []
            at = block[node]
        if not page.no_text[node]:
            part.append(text)
    out.append("".join(part))
    return "\n".join(t for t in (" ".join(p.split()) for p in out) if t)


def extract_main_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with the column text."""

    @F.pandas_udf("string")
    def extract(sources: pd.Series) -> pd.Series:
        return pd.Series([main_text(s) for s in sources], index=sources.index, dtype=object)

    return pages.withColumn("text", extract(F.col(html_col)))
