"""Main-text extraction from raw HTML by two passes of block rules (operator 2).

A page is cut into blocks at block-level tags. The first pass decides each block from where it
stands (a menu, header, footer, sidebar, notice, advert, form or comment section is never main
text; with an ``article`` or ``main`` on the page nothing outside it is), from its link density,
its length and the share of stop words (where the page is in one of their languages; else length
and links alone decide). Short blocks and blocks of middling stop-word density stay ambiguous; the
second pass gives them the label of the nearest decided neighbour (a heading: of what follows;
one in the same element counts as nearer than one outside). On a page without a good block the
ambiguous ones are the main text.

An element's class or id counts by whole names: ``comment-list`` is a comment section,
``comments-open`` says something about an article. A form that holds most of the page's text is
the page. Inside an article only lists of links are left out, not paragraphs with many.

Null and empty pages have no text. Rows are independent, so repeated rows give equal results; ties
between neighbours are decided by the block's length. Very long and very deep pages cost time in
proportion to their size. An empty table stays empty; other columns pass through, whatever their
names."""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_spark.llm import common

#: Characters below which a block without landmark is ambiguous, and from which it can be good.
SHORT, LONG = 70, 200
#: Shares of stop words from which a block is near good, and good when it is long.
STOP_LOW, STOP_HIGH = 0.15, 0.25
#: Share of linked characters above which a block is not main text.
LINKS = 0.4

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset("""
the of and to a in is it that was for on are as with his they at be this have from or one had by
but not what all were we when your can said there an which she do their if will each about how
der die das und in zu den ist nicht von mit dem des sich ein eine auf für im als auch es an aus
er hat dass sie nach wird bei einer um am sind noch wie einem über so zum war haben nur oder aber
le la les de des du et un une en est que qui dans pour pas sur au aux par il elle ne ce se plus
avec son sa ses ou mais comme ont cette nous vous leur sont être été fait
el los las y una por con para del se su lo no al más pero sus ya o este sí porque esta entre
cuando muy sin sobre también me hasta hay donde quien desde todo nos durante son fue
""".split())

_BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section
summary table tbody td tfoot th thead tr ul""".split())
_LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_RAW = ("script", "style", "title", "textarea", "noscript", "template", "svg", "iframe", "select", "object", "button")
_VOID = frozenset("br hr img input meta link wbr area base col embed source track param".split())
_CHROME_TAGS = frozenset("nav footer aside dialog menu".split())
_CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_CHROME_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner
cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup
sidebar side rail menu menus nav navbar navigation breadcrumb breadcrumbs masthead topbar footer comment comments
disqus reply replies respond share sharing social related recommended recommendations widget widgets toolbar pagination
pager login search form forms copyright legal disclaimer outbrain taboola""".split())
#: Words that say nothing of what an element holds, beside one that does.
_PLAIN_NAMES = frozenset("""area article aside bar block blocks body bottom box button buttons center col column container content
custom element entry fixed global group header holder icon icons inner item items left line link links list lists main module outer page
panel post primary reader row secondary section sections site slot small sticky text title top unit user wrap wrapper right region""".split())
#: Elements that a landmark keeps even if most of their text is linked.
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dd dt td th figcaption".split())
#: Share of stop words in a page's longer blocks from which its language is one of theirs.
STOP_KNOWN = 0.1
_HEADER_NAMES = frozenset("header headers".split())

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(_RAW) + r")\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)>|<[!?/][^>]*(?:>|\Z)|<[a-z][^>]*\Z",
    re.I | re.S)
_ATTR = re.compile(r"([a-z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAME = re.compile(r"[a-z]+", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Block:
    """Text of a block with what its decision rests on."""

    text: str
    linked: int
    chrome: bool
    landmark: bool
    heading: bool
    parent: int = 0
    tag: str = ""
    form: int = 0

    def stop_share(self) -> float:
        words = self.text.lower().split()
        return sum(w.strip(".,;:!?()\"'") in STOP_WORDS for w in words) / len(words) if words else 0.0


def _is_chrome(tag: str, attrs: str, inside_landmark: bool) -> bool:
    if tag in _CHROME_TAGS or (tag == "header" and not inside_landmark):
        return True
    if not attrs or "=" not in attrs and "hidden" not in attrs:
        return False
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name == "role" and value.lower() in _CHROME_ROLES:
            return True
        if name in ("class", "id") and tag not in ("html", "body", "main"):
            for token in value.split():
                words = {x.lower() for x in _NAME.findall(_CAMEL.sub(" ", token)) if len(x) > 1}
                if words <= _CHROME_NAMES | _PLAIN_NAMES and (words & _CHROME_NAMES or words & _HEADER_NAMES and not inside_landmark):
                    return True
    return False


def _is_landmark(tag: str, attrs: str) -> bool:
    return tag in ("article", "main") or bool(attrs) and bool(
        re.search(r"role\s*=\s*[\"']?(?:main|article)\b|itemprop\s*=\s*[\"']?articleBody", attrs, re.I))


class _Open:
    """The open elements, each with what holds inside it, and how many of each tag there are."""

    def __init__(self):
        self.stack: list[tuple[str, bool, bool, int, int]] = [("", False, False, 0, 0)]  # tag, chrome, landmark, number, form
        self.count: dict[str, int] = {}
        self.opened = 0

    def push(self, tag: str, chrome: bool, landmark: bool) -> None:
        _, in_chrome, in_landmark, _, form = self.stack[-1]
        self.opened += 1
        if tag == "form" and not form:
            form = self.opened
        self.stack.append((tag, chrome or in_chrome, landmark or in_landmark, self.opened, form))
        self.count[tag] = self.count.get(tag, 0) + 1

    def pop(self) -> str:
        tag = self.stack.pop()[0]
        self.count[tag] -= 1
        return tag

    def close(self, tag: str) -> bool:
        """Close the innermost ``tag`` and what is open in it; false if there is none."""
        if not self.count.get(tag):
            return False
        while self.pop() != tag:
            pass
        return True

    def top(self) -> tuple[str, bool, bool, int, int]:
        return self.stack[-1]


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order; empty ones are left out."""
    out: list[Block] = []
    open_ = _Open()
    parts: list[str] = []
    linked = 0
    in_link = 0
    heading = False

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                tag, chrome, landmark, number, form = open_.top()
                if tag in _LEAF:
                    number = open_.stack[-2][3]
                out.append(Block(text, linked, chrome, landmark, heading, number, tag, form))
            parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if in_link:
                linked += len("".join(text.split()))

    at = 0
    for m in _PIECE.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = 0 if m["close"] else 1
        elif tag not in _BLOCK:
            # Inline containers can hide text, too: a marked span is a block of its own.
            if m["close"]:
                if open_.count.get(tag):
                    flush()
                    open_.close(tag)
            elif tag not in _VOID and m["attrs"] and not m["attrs"].endswith("/") and _is_chrome(tag, m["attrs"], open_.top()[2]):
                flush()
                open_.push(tag, True, False)
        elif m["close"]:
            flush()
            heading = False
            in_link = 0
            open_.close(tag)
        else:
            flush()
            in_link = 0
            heading = tag in _HEADING
            if tag in ("p", "hr"):
                if open_.top()[0] == "p":
                    open_.pop()
                if tag == "hr":
                    continue
            elif tag == "li" and open_.top()[0] == "li":
                open_.pop()
            open_.push(tag, _is_chrome(tag, m["attrs"], open_.top()[2]), _is_landmark(tag, m["attrs"]))
    add(page[at:])
    flush()
    return out


def _without_forms(found: list[Block]) -> list[Block]:
    """Forms made chrome, but for one that holds more than half of the text that is left."""
    sizes: dict[int, int] = {}
    for b in found:
        if not b.chrome:
            sizes[b.form] = sizes.get(b.form, 0) + len(b.text)
    total = sum(sizes.values())
    return [replace(b, chrome=True) if b.form and not b.chrome and 2 * sizes[b.form] <= total else b for b in found]


def classify(found: list[Block]) -> list[bool]:
    """Whether each block is main text."""
    found = _without_forms(found)
    landmarks = any(b.landmark and not b.chrome for b in found)
    longer = [b.stop_share() for b in found if not landmarks and not b.chrome and len(b.text) >= SHORT]
    known = bool(longer) and max(longer) >= STOP_KNOWN
    label: list[bool | None] = []
    for b in found:
        size = len("".join(b.text.split()))
        links = b.linked > LINKS * size and not (landmarks and b.tag in _PROSE)
        if b.chrome or landmarks and not b.landmark or links:
            label.append(False)
        elif landmarks:
            label.append(None if b.heading or len(b.text) < SHORT else True)
        elif len(b.text) < SHORT:
            label.append(False if "©" in b.text else None)
        elif not known:
            label.append(True if len(b.text) >= LONG or size == len(b.text) else None)
        else:
            stop = b.stop_share()
            label.append(True if stop >= STOP_HIGH and len(b.text) >= LONG else None if stop >= STOP_LOW else False)
    if True not in label:
        return [x is None for x in label]
    # Inside an article only its own blocks are neighbours; menus and adverts around it are not.
    near = [b.landmark and not b.chrome or not landmarks for b in found]
    decided = [i for i, x in enumerate(label) if x is not None and near[i]]
    good = []
    for i, x in enumerate(label):
        if x is not None:
            good.append(x)
            continue
        at = bisect_left(decided, i)
        before = decided[at - 1] if at else None
        after = decided[at] if at < len(decided) else None
        sides = [bool(label[j]) for j in (before, after) if j is not None]
        substantial = landmarks or len(found[i].text) >= SHORT
        if not sides:
            good.append(True)
        elif found[i].heading and after is not None:
            good.append(sides[-1] or landmarks and any(sides))
        elif len(sides) == 1:
            good.append(sides[0])
        elif (found[before].parent == found[i].parent) != (found[after].parent == found[i].parent):
            good.append(sides[0] if found[before].parent == found[i].parent else sides[1])
        elif i - before != after - i:
            good.append(sides[0] if i - before < after - i else sides[1])
        else:
            good.append(any(sides) if substantial else all(sides))
    return good


def main_text(page: str | None) -> str:
    """The main text of a page; empty for null, empty or text-free pages."""
    if not page:
        return ""
    found = blocks(page)
    return " ".join(b.text for b, keep in zip(found, classify(found)) if keep)


def extract(pages: DataFrame, html_col: str = "html") -> tuple[DataFrame, str]:
    """``pages`` plus a struct (its name is returned too): text and n_chars (code points).

    Null and empty pages have no text. Unclosed and cut-off tags and references are taken as
    browsers do: a tag without end is dropped, a broken reference stays as written."""
    def run(texts):
        out = [main_text(t.as_py()) for t in texts]
        return [pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())]

    return common.with_result(pages, html_col, "text: string, n_chars: bigint", run)


def op2_html_text(spark, sf_dir: str) -> DataFrame:
    """Every page with its main text."""
    done, r = extract(common.read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return done.select("page_id", "url", F.col(r)["text"].alias("text"), F.col(r)["n_chars"].alias("n_chars"))
