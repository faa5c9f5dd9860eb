"""Main text of web pages by two passes of block rules.

The page is read once as tags and text. Elements that are boilerplate by name, role or class go
with all they hold; the rest is cut into blocks at block-level tags. The first pass labels a block
by stop-word density, length and link density; the second gives each ambiguous block the label of
its nearest decided neighbour.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Batches, small_batches

# Common function words of the four languages, and names of page parts.
STOP_WORDS = frozenset(
    """a about all also an and are as at be been but by can could did do does for from had has have he her his how i if in into is it its me more
    my no not of on one or our out she so some than that the their them then there these they this to up was we were what when which who will with
    would you your al algo aunque bajo como con de del donde dos el ella ellos en entre era es esta este ha hay la las le lo los mas me mi muy ni
    para pero por que se ser si sin sobre son su sus también un una y ya au aux avec ce ces cette dans des du elle est et eux il ils je leur lui
    mais mes ne nous ou où par pas plus pour qu qui sa ses sont sur une vous aber als am an auch auf aus bei bin bis das dass dem den der des die
    doch durch ein eine einem einen einer es für hat hatte ich ihr im ist kann mit nach nicht noch nur oder sich sie sind so über um und uns von
    vor war wenn werden wie wir wird zu zum zur""".split()
)
DROPPED_TAGS = frozenset("head nav footer aside form iframe svg canvas object select button dialog menu template noscript script style textarea audio video map".split())
DROPPED_WORDS = frozenset(
    """ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices
    alert popup modal overlay newsletter subscribe subscription signup sidebar sidenav widget widgets menu nav navbar navigation breadcrumb
    breadcrumbs toolbar pagination pager footer masthead topbar share sharing social related recommended recommendations comment comments
    commentlist disqus respond replies login search paywall disclaimer""".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
BLOCK_TAGS = frozenset(
    """address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hgroup hr html li
    main ol p pre section summary table tbody td tfoot th thead tr ul""".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())

#: Of these, the names of what readers write: an element called so never is the article.
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond replies".split())
#: Block rules: characters of a short block; stop-word shares; link shares outside and inside an article; so many linked
#: blocks in a row inside one are a menu.
SHORT, STOP_LOW, STOP_HIGH, LINKS, LINKS_INSIDE, MENU = 70, 0.12, 0.30, 0.2, 0.5, 4

ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
NAME = re.compile(r"<(/?)([a-zA-Z][\w:-]*)")
#: Where a tag ends, or a quoted value begins in it.
STEP = re.compile(r""">|=\s*(["'])""")
PART = re.compile(r"[A-Za-z]+")
LETTERS = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    links: float
    heading: bool
    region: str
    label: str = field(default="")


def _boilerplate(name: str, attributes: str, inside: bool) -> str:
    """How surely an element is boilerplate: "sure" by tag, role or being hidden, "comments" or "named" by a whole class name, "part" by a part of one, or empty."""
    if name in DROPPED_TAGS or name == "header" and not inside:
        return "sure"
    if not attributes or name in ("html", "body", "main"):
        return ""
    found = ""
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id"):
            for token in value.split():
                words = PART.findall(token)
                if any(w in DROPPED_WORDS for w in words) or "header" in words and not inside:
                    whole = len(words) == 1
                    found = "comments" if found == "comments" or whole and words[0] in COMMENT_WORDS else "named" if whole or found == "named" else "part"
        elif key == "role" and value in DROPPED_ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return "sure"
        elif key == "style" and re.search(r"display\s*:\s*none", value):
            return "sure"
    return found


def _tags(html: str) -> list[tuple[int, int, str, bool, str]]:
    """(start, end, name, closing, attributes) of each tag; comments have no name; script and style bodies are passed over.

    One scan: a quoted value begins after an equals sign and may hold ``>``. If a value never ends, its tag ends at the first
    ``>``; places from which a scan has failed so are remembered, so none is scanned twice.
    """
    found, at, dead = [], 0, set()
    last = {q: html.rfind(q) for q in ">\"'"}

    def end_of(place: int) -> int:
        first, seen = place, []
        while m := STEP.search(html, place):
            if m.start() in dead:
                break
            if m[0] == ">":
                return m.end()
            seen.append(m.start())
            if m.end() > last[m[1]]:  # the value has no end
                break
            place = html.index(m[1], m.end()) + 1
        dead.update(seen)
        return html.index(">", first) + 1

    while (start := html.find("<", at)) >= 0:
        if html.startswith("<!--", start) or html.startswith("<![CDATA[", start):
            end = html.find("-->" if html[start + 2] == "-" else "]]>", start + 4)
            at = end + 3 if end >= 0 else len(html)
            found.append((start, at, "", False, ""))
        elif start > last[">"]:  # no tag ends from here on
            break
        elif html[start + 1] in "!?":
            at = html.index(">", start) + 1
            found.append((start, at, "", False, ""))
        elif m := NAME.match(html, start):
            at = end_of(m.end())
            name, closing = m[2].lower(), bool(m[1])
            found.append((start, at, name, closing, html[m.end() : at - 1]))
            if name in ("script", "style") and not closing:
                end = re.compile(f"</{name}", re.I).search(html, at)
                at = end.start() if end else len(html)
        else:
            at = start + 1
    return found


class Outline:
    """What holds what: each tag's closing tag, and counts of text and of article and main elements up to each tag."""

    def __init__(self, html: str, tags: list[tuple]):
        n = len(tags)
        self.tags, self.closing = tags, [None] * n
        opened: dict[str, list[int]] = {}
        for i, (_, _, name, closing, _) in enumerate(tags):
            if not closing:
                opened.setdefault(name, []).append(i)
            elif opened.get(name):
                self.closing[opened[name].pop()] = i
        self.texts, self.plain, self.mains, self.articles = [0], [0], [0], [0]
        self.largest = -1  # of the article elements, the one with the most text
        sure, named, until = 0, 0, -1
        for j, (_, end, name, closing, attributes) in enumerate(tags):
            sure = max(0, sure + (-1 if closing else 1) * (name in DROPPED_TAGS and name not in VOID_TAGS))
            if j > until and not closing and name not in VOID_TAGS and _boilerplate(name, attributes, True) in ("named", "comments"):
                until = self.closing[j] if self.closing[j] is not None else j
            named = j <= until
            upto = tags[j + 1][0] if j + 1 < n else len(html)
            size = 0 if sure else len(html[end:upto].strip())
            self.texts.append(self.texts[-1] + size)
            self.plain.append(self.plain[-1] + size * (not named))
            self.mains.append(self.mains[-1] + (name == "main" and not closing))
            self.articles.append(self.articles[-1] + (name == "article" and not closing))
        sizes = {i: self.plain[self.end(i)] - self.plain[i] for i, t in enumerate(tags) if t[2] == "article" and not t[3]}
        if sizes:
            self.largest = max(sizes, key=sizes.__getitem__)

    def end(self, at: int) -> int:
        return len(self.tags) - 1 if self.closing[at] is None else self.closing[at]

    def holds_the_text(self, at: int, kind: str) -> bool:
        """Whether an element that its class names as boilerplate is the article or wraps it, by the share of the page's text it holds.

        Reader comments never do. A whole class name is outweighed by a main element inside, or by articles with most of
        the text; a part of one by a main element, by most of the text that nothing else names, or by being the largest article.
        """
        end = self.end(at)
        if kind == "comments":
            return False
        if self.mains[end] > self.mains[at + 1]:
            return True
        if kind == "named":
            return self.articles[end] > self.articles[at + 1] and 2 * (self.texts[end] - self.texts[at]) > self.texts[-1]
        return at == self.largest or 2 * (self.plain[end] - self.plain[at]) > self.plain[-1]


def blocks(html: str) -> list[Block]:
    """The page's blocks in order, without boilerplate elements."""
    tags, out = _tags(html), []
    parts: list[str] = []
    inner = {"article": 0, "main": 0, "a": 0}
    linked, breaks, heading = 0, 0, False

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            region = "article" if inner["article"] else "main" if inner["main"] else "page"
            out.append(Block(text, min(1.0, linked / len(text)), heading, region))
        parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked, breaks
        if raw:
            text = unescape(raw)
            parts.append(text)
            if text.strip():
                breaks = 0
                linked += len(text) * bool(inner["a"])

    outline = Outline(html, tags)
    i, at = 0, 0
    unclosed: set[str] = set()
    while i < len(tags):
        start, end, name, closing, attributes = tags[i]
        add(html[at:start])
        at = end
        kind = _boilerplate(name, attributes, bool(inner["article"] or inner["main"])) if name and not closing and name not in VOID_TAGS and name not in unclosed else ""
        last = outline.closing[i] if kind and not attributes.endswith("/") else None
        if kind and kind != "sure" and outline.holds_the_text(i, kind):
            kind = ""
        if kind:
            if name not in ("script", "style", "noscript", "template", "svg"):
                close()
            if last is not None:
                i, at = last + 1, tags[last][1]
                continue
            if name in ("script", "style"):  # never closed: the browser would read it to the end
                at = len(html)
                break
            unclosed.add(name)
        elif name == "br":
            breaks += 1
            close() if breaks > 1 else parts.append(" ")
        elif name == "a":
            inner["a"] = 0 if closing else 1
        elif name in BLOCK_TAGS:
            close()
            inner["a"] = 0
            if name in inner:
                inner[name] = max(0, inner[name] + (-1 if closing else 1))
            heading = not closing and len(name) == 2 and name[0] == "h" and name[1].isdigit()
        i += 1
    add(html[at:])
    close()
    return out


def stop_share(text: str) -> float:
    words = LETTERS.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def decide(block: Block, known: bool) -> str:
    """First pass: good, bad, or empty for ambiguous. ``known``: the page is in a language whose stop words are known; else length decides."""
    inside = block.region != "page"
    if block.links > (LINKS_INSIDE if inside else LINKS):
        return "" if inside else "bad"
    if len(block.text) < (SHORT if known else SHORT // 2) or block.heading:
        return "bad" if not inside and ("©" in block.text or "copyright" in block.text.lower()) else ""
    if not known:
        return "good"
    share = stop_share(block.text)
    if share >= STOP_HIGH or share >= STOP_LOW and (inside or len(block.text) >= 3 * SHORT):
        return "good"
    return "" if inside or share >= STOP_LOW else "bad"


def _menus(found: list[Block]) -> list[tuple[int, int]]:
    """Stretches of at least MENU blocks in a row that are mostly links."""
    out, begin = [], 0
    for i in range(len(found) + 1):
        if i == len(found) or found[i].links <= LINKS_INSIDE:
            if i - begin >= MENU:
                out.append((begin, i))
            begin = i + 1
    return out


def region_of(found: list[Block], labels: list[str]) -> tuple[str, ...]:
    """The narrowest of article, main with article, and page that holds at least half of the characters of good blocks."""
    good = {r: sum(len(b.text) for b, label in zip(found, labels, strict=True) if label == "good" and b.region == r) for r in ("article", "main", "page")}
    total = sum(good.values())
    if any(b.region == "article" for b in found) and 2 * good["article"] >= total and not good["main"]:
        return ("article",)
    if any(b.region != "page" for b in found) and 2 * (good["article"] + good["main"]) >= total:
        return "article", "main"
    return "article", "main", "page"


def main_text(html: str | None) -> str:
    """The page's article: blocks joined by one newline, empty if there are none.

    Blocks outside the region that holds the good text are left out, and the edges of an article or
    main element count as good neighbours; those of the page count as bad ones.
    """
    found = blocks(html or "")
    long = " ".join(b.text for b in found if len(b.text) >= SHORT // 2 and b.links <= LINKS)
    known = not long or stop_share(long) >= STOP_LOW / 2
    first = [decide(b, known) for b in found]
    for begin, end in _menus(found):
        first[begin:end] = ["bad"] * (end - begin)
    region = region_of(found, first)
    own = [b for b in found if b.region in region]
    labels = [x for b, x in zip(found, first, strict=True) if b.region in region]
    edge = "bad" if "page" in region and any(labels) else "good"
    n = len(own)
    before, after = [(edge, 0)] * n, [(edge, 0)] * n
    last = (edge, -1)
    for i in range(n):
        before[i] = last
        last = (labels[i], i) if labels[i] else last
    last = (edge, n)
    for i in reversed(range(n)):
        after[i] = last
        last = (labels[i], i) if labels[i] else last
    kept = []
    for i, b in enumerate(own):
        label = labels[i]
        if not label:
            (left, l), (right, r) = before[i], after[i]
            label = left if left == right or i - l < r - i else right if r - i < i - l else "good"
            if b.heading and right == "good":  # a heading goes with what stands below it
                label = "good"
        if label == "good":
            kept.append(b.text)
    return "\n".join(kept)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for each row of ``pages``; a null html gives an empty text.

    Repeated rows stay, an empty table gives an empty table, extra columns are ignored.
    """
    small_batches(pages.sparkSession)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts = [main_text(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = dict(pages.dtypes)
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind['page_id']}, url string, text string, n_chars long")
