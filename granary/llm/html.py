"""Main-text extraction: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering of the lines into a content region.

The clusters decide: lines whose smoothed ratio is in the upper cluster are content lines, and the element that holds most of their text is the content region. Structure settles only what the ratio leaves open: short lines of the region (headings, list items) stay, and the elements that HTML defines as no main content (nav, footer, aside, form, ...) go unless the content lines themselves are in them. Reader comments and advertisements are told by repeated structure, links and labels (see ``_boxes``). Names of classes and ids are not looked at.

A page is read as browsers read it where end tags are left out; a hidden element without its end tag (a button, a list of choices) hides nothing from the next block on.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

from pyspark.sql import DataFrame

from granary.llm.common import arrow_map

VOID = set("area base br col embed hr img input link meta source track wbr".split())
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements without text of the page; elements that HTML defines as no main content, and the same as roles.
HARD = set("button canvas datalist head iframe noscript object option script select style svg template textarea title".split())
SOFT = set("aside dialog footer form header menu nav".split())
ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
CONTAINER = set("article aside blockquote body center dialog div dl fieldset figure footer form header main menu nav ol section table td th ul".split())
WHOLE = ("article", "main")
#: A start tag ends these open ones.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Smoothing; the share of the content lines' text that makes an element the region; links from which a list of nothing else is a menu.
SIGMA, RADIUS, MAJORITY, LINKS = 1.0, 2, 0.6, 3
#: Articles are the region already with this share of the lines whose ratio is at least this part of the threshold: the ratio hardly tells short lines apart, so structure breaks the tie.
ARTICLE, NEAR = 0.25, 0.25
#: What may stand in a head: any other start tag, or text, ends it.
META = set("base head link meta noscript object script style template title".split())
#: Start tags that no button or list of choices can hold: where its own end tag never comes, what they begin is text of the page.
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
#: Reader comments are equal boxes, each with a short line of a time, or with the same short last line (as a link to reply): how long these lines may be.
STAMPED, REPLY = 60, 25
STAMP = re.compile(r"\b\d{1,2}[:.h]\d{2}\b|\b\d{4}-\d{2}-\d{2}\b|\b(?:19|20)\d\d\b")
#: Lines with which boxes say that they are advertisements.
LABELS = {"ad", "ads", "advertisement", "advertorial", "sponsored", "sponsored content", "promoted", "anzeige", "werbung", "publicité", "annonce", "sponsorisé", "publicidad", "anuncio", "patrocinado"}
TOKEN = re.compile(r"<!--|<(script|style)\b", re.I)
RAW_END = {t: re.compile(rf"</{t}\b", re.I) for t in ("script", "style")}
QUOTED = re.compile(r"<[a-zA-Z][^<>]*=\s*([\"'])[^\"'<>]*\Z")
UNENDED = re.compile(r"<(?:[/!?a-zA-Z]|$)")


class Lines(HTMLParser):
    """Turns the event stream into lines (text, tags seen, container, characters in links) and a table of containers (parent, tag, soft, outermost article or main, number of links, whether it leads around the site). Each event costs amortised constant time, however deep elements are left open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines, self.text, self.tags, self.linked = [], [], 0, 0
        self.open, self.count, self.hard, self.links = [("", 0, False)], {}, 0, 0
        self.veiled, self.veil, self.past, self.lifted = [], 0, False, []  # text in hidden elements, their number, whether a block began in the one that is open, and which had no end tag
        self.name, self.stamped, self.headed = [""], [False], [False]
        self.parent, self.soft, self.whole, self.menu, self.way = [0], [False], [-1], [0], [False]

    def flush(self):
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append((text, self.tags, self.open[-1][1], self.linked, -1))
        if self.hard and self.past and (text := " ".join("".join(self.veiled).split())):
            self.lines.append((text, self.tags, self.open[-1][1], self.linked, self.veil))
        self.text, self.veiled, self.tags, self.linked = [], [], 0, 0

    def pop(self, ended=False):
        tag, _, hard = self.open.pop()
        self.count[tag] -= 1
        self.hard -= hard
        if hard and not self.hard and not ended:
            self.lifted.append(self.veil)
        self.links -= tag == "a"

    def end_head(self):
        while self.count.get("head"):
            self.pop()

    def handle_starttag(self, tag, attrs):
        if self.count.get("head") and (tag == "body" or tag not in META and self.open[-1][0] in ("head", "title")):
            self.end_head()
        if tag == "button" and self.open[-1][0] == "button" or self.count.get("select") and tag in ("button", "input", "select", "textarea"):
            self.end({tag, "select"})
        if tag in BLOCK:
            self.flush()
            self.past = self.hard > 0
            self.end({"p"})
        if tag in ENDS:
            self.end(ENDS[tag])
        self.tags += 1
        if tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        node = self.open[-1][1]
        if tag in CONTAINER:
            outer, role = self.whole[node], next((v for k, v in attrs if k == "role" and v), "")
            nested = outer >= 0 and tag == "article"  # HTML: related to the outer one, as comments are
            soft = tag != "body" and (tag in SOFT and not (tag == "header" and outer >= 0) or nested or role.lower().strip() in ROLES)
            self.parent.append(node)
            self.soft.append(soft)
            self.whole.append(outer if outer >= 0 or tag not in WHOLE else len(self.whole))
            self.name.append(tag)
            self.stamped.append(False)
            self.headed.append(False)
            self.menu.append(0)
            self.way.append(tag in ("menu", "nav") or role.lower().strip() in ("menu", "menubar", "navigation"))
            node = len(self.parent) - 1
        self.stamped[node] |= tag == "time"
        self.headed[node] |= tag in HEADINGS
        hard = tag in HARD
        if hard and not self.hard:
            self.veil, self.past = self.veil + 1, False
        self.open.append((tag, node, hard))
        self.count[tag] = self.count.get(tag, 0) + 1
        self.hard += hard
        if tag == "a":
            self.links += 1
            self.menu[node] += 1

    def end(self, tags):
        """Closes the innermost of the tags unless a container lies between."""
        if any(self.count.get(t) for t in tags):
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k][0] in tags:
                    while len(self.open) > k:
                        self.pop()
                    return
                if self.open[k][0] in CONTAINER:
                    return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.flush()
        self.tags += 1
        if self.count.get(tag):
            while self.open[-1][0] != tag:
                self.pop()
            self.pop(True)

    def handle_data(self, data):
        if self.open[-1][0] == "head" and data.strip():
            self.end_head()
        if self.hard:
            self.veiled.append(data)
        else:
            self.text.append(data)
            self.linked += len(data.strip()) if self.links else 0

    def seen(self):
        """The lines of the page. What stands after the first block in an element that hides its text, but has no end tag, is the page's."""
        while len(self.open) > 1:
            self.pop()
        lifted = {-1, *self.lifted}
        return [x[:4] for x in self.lines if x[4] in lifted]


def smoothed(ratios: list[float]) -> list[float]:
    kernel = [math.exp(-(k * k) / (2 * SIGMA * SIGMA)) for k in range(-RADIUS, RADIUS + 1)]
    out = []
    for i in range(len(ratios)):
        near = [(kernel[k + RADIUS], ratios[i + k]) for k in range(-RADIUS, RADIUS + 1) if 0 <= i + k < len(ratios)]
        out.append(sum(a * b for a, b in near) / sum(a for a, _ in near))
    return out


def threshold(values: list[float]) -> float:
    """Two clusters on a line: the middle of their means, from the extremes until it is stable. The cut moves over sorted values, which have finitely many places for it."""
    v = sorted(values)
    total = [0.0]
    for x in v:
        total.append(total[-1] + x)
    low, high, seen = v[0], v[-1], set()
    while True:
        cut = (low + high) / 2
        k = _first(v, cut)
        if k in seen:
            return cut
        seen.add(k)
        low, high = total[k] / k if k else low, (total[-1] - total[k]) / (len(v) - k) if k < len(v) else high


def _first(v: list[float], cut: float) -> int:
    from bisect import bisect_left

    return bisect_left(v, cut)


def _ended(html: str) -> str:
    """Without a comment or tag that is not ended: it reaches to the end of the page, and the parser would look for its end again and again. What looks like a comment in a script, a style or the value of an attribute is none."""
    at = 0
    while m := TOKEN.search(html, at):
        if m[1]:
            end = RAW_END[m[1].lower()].search(html, m.end())
            if not end:
                return html
            at = end.end()
            continue
        if (quote := QUOTED.search(html[html.rfind("<", at, m.start()) : m.start()]) if html.rfind("<", at, m.start()) >= 0 else None) and html.find(quote[1], m.end()) >= 0:
            at = m.end()
            continue
        end = html.find("-->", m.start() + 2)
        if end < 0:
            html = html[: m.start()]
            break
        at = end + 3
    at = UNENDED.search(html, html.rfind(">") + 1)
    return html[: at.start()] if at else html


def main_text(html: str | None) -> str:
    """The page's main text, blocks joined by a newline; '' for null, empty or textless pages."""
    if not html:
        return ""
    html = _ended(html)
    p = Lines()
    p.feed(html)
    p.close()
    p.flush()
    p.lines = p.seen()
    if not p.lines:
        return ""
    n, aside = len(p.parent), [False]
    for k in range(1, len(p.parent)):  # children come after their parents
        aside.append(p.soft[k] or aside[p.parent[k]])
    found = [x for x in p.lines if not aside[x[2]]] if any(p.whole[x[2]] >= 0 and not aside[x[2]] for x in p.lines) else p.lines
    s = smoothed([len(text) / max(1, tags) for text, tags, *_ in found])
    cut = threshold(s)
    content, every, linked = [0] * n, [0] * n, [0] * n
    for v, (text, _, node, links) in zip(s, found):
        content[node] += len(text) if v >= cut else 0
        every[node] += len(text)
        linked[node] += min(links, len(text))
    own, own_content = list(every), list(content)
    for k in range(n - 1, 0, -1):
        for sums in (content, every, linked, p.menu):
            sums[p.parent[k]] += sums[k]
    least = MAJORITY * content[0]
    gone = [False] * n
    for k in range(1, n):
        gone[k] = gone[p.parent[k]] or p.soft[k] and (content[k] < least or p.way[k])
    boxed = _boxes(p, found, content, every, linked)
    for k in range(1, n):
        gone[k] = gone[k] or gone[p.parent[k]] or k in boxed
    kept = [x for x in found if not gone[x[2]]]
    held: dict[int, int] = {}
    near = [(len(x[0]), p.whole[x[2]]) for v, x in zip(s, found) if v >= NEAR * cut and not gone[x[2]]]
    for size, k in near:
        if k >= 0:
            held[k] = held.get(k, 0) + size
    if held and sum(held.values()) >= ARTICLE * sum(size for size, _ in near):  # the articles that hold the content lines, whole
        return "\n".join(x[0] for x in kept if p.whole[x[2]] in held and not _menu(p, x[2], content, every, linked))
    region = 0
    for k in range(1, n):
        if p.parent[k] == region and content[k] >= least and not gone[k]:
            region = k
    inside, above, at = [k == region for k in range(n)], {0}, region
    for k in range(1, n):
        inside[k] = inside[k] or inside[p.parent[k]]
    while at:
        above.add(at)
        at = p.parent[at]
    where = {id(x): v >= cut for x, v in zip(found, s)}
    return "\n".join(x[0] for x in kept if where[id(x)] or 2 * own_content[x[2]] >= own[x[2]] or x[2] in above and 2 * x[3] < len(x[0]) or inside[x[2]] and not _menu(p, x[2], content, every, linked))


def _boxes(p: Lines, found: list, content: list[int], every: list[int], linked: list[int]) -> set[int]:
    """Containers of reader comments and advertisements, told by structure: equal boxes beside each other, all without headings and of two lines or more, all with a time or all with the same short last line; what says that it is an advertisement, and a box that is one link. None that has most of the content."""
    n = len(p.parent)
    lines, low, high, stamped, headed = [0] * n, [len(found)] * n, [-1] * n, list(p.stamped), list(p.headed)
    for i, (text, _, k, _) in enumerate(found):
        stamped[k] |= len(text) <= STAMPED and bool(STAMP.search(text))
        lines[k], low[k], high[k] = lines[k] + 1, min(low[k], i), i
    for k in range(n - 1, 0, -1):  # children come after their parents
        up = p.parent[k]
        stamped[up], headed[up] = stamped[up] or stamped[k], headed[up] or headed[k]
        lines[up], low[up], high[up] = lines[up] + lines[k], min(low[up], low[k]), max(high[up], high[k])
    first = [found[i][0] if i < len(found) else "" for i in low]
    last = [found[i][0] if i >= 0 else "" for i in high]
    most, out, alike = content[0] / 2, set(), {}
    for k in range(1, n):
        if lines[k]:
            alike.setdefault((p.parent[k], p.name[k]), []).append(k)
        if lines[k] and content[k] < most and (first[k].lower().strip(" :") in LABELS or p.name[k] in ("div", "section") and lines[k] == 1 and p.menu[k] == 1 and linked[k] >= 0.9 * every[k] and content[k] < NEAR * most):
            out.add(k)
    for (parent, _), items in alike.items():
        said = sum(content[k] for k in items)
        if len(items) < 2 or said > most or not all(lines[k] > 1 and not headed[k] for k in items):
            continue
        same = {last[k] for k in items}
        if all(stamped[k] for k in items) or len(same) == 1 and len(last[items[0]]) <= REPLY:
            out.update(items)
            whole = sum(every[k] for k in items)
            if parent and every[parent] - whole <= 0.3 * whole and content[parent] <= most:
                out.add(parent)
    return out


def _menu(p: Lines, node: int, content: list[int], every: list[int], linked: list[int]) -> bool:
    """A list of nothing but links, none of them a content line."""
    return not content[node] and p.menu[node] >= LINKS and 10 * linked[node] >= 9 * every[node]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of pages (page_id, url, html). Null html: empty text, 0. Equal rows: each. Empty table: no rows. Very long pages take time in proportion to their length. Other columns are ignored, also those named as the results. Row by row: no shuffle."""

    def make():
        def f(b):
            text = [main_text(h) for h in b["html"]]
            return b | {"text": text, "n_chars": [len(t) for t in text]}

        return f

    kind = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return arrow_map(pages.select("page_id", "url", "html"), make, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long")
