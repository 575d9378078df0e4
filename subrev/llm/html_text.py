"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of tokens: words, which score positive where articles are made
of them, and tags, which score negative.  The scores are log likelihood ratios
learnt from labelled pages; a page labels itself where it marks its article with
``<article>`` or ``<main>``.  A linear scan finds the contiguous region of the best
sum, and its blocks are the text.  Elements that are never text (scripts, menus,
adverts, comments of readers, ...) count as one tag and their words as none.

The scores are fitted on a bounded sample, ``SAMPLE_PAGES`` pages chosen by a hash;
the contexts counted are the known tags, so the table that reaches the driver is
small whatever the pages hold.

A page without a mark of its own on which nothing scores is scanned with the scores of
unseen contexts.

A hidden element, or one whose class, id or role has a whole token that names something
else than text, is left out too, unless it has all the marked articles of the page or, on
a page without any, most of its words.

Defined results: null or empty html, and a page without words outside the elements
left out, give the empty text; of regions with equal sums the first and then the
longest is taken; broken or unclosed tags end with the element around them; repeated
rows get rows of their own; other columns are ignored; an empty table has no row, and
learns nothing.
"""

from __future__ import annotations

import html
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subrev.llm.common import by_batch

SAMPLE_PAGES = 2000
#: No tag scores above this, and the least score a word or tag can get.
TAG_MOST = -0.01
LEAST = -12.0

# Fixed values of HTML: elements that end the line they are in, elements without an end tag, and elements whose content is no markup.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr
    ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "xmp")
# Elements that are never article text.
LEFT_OUT = frozenset("""head title nav footer aside form menu dialog button select option label fieldset input object applet canvas audio video map
    """.split()) | frozenset(RAW)
# Whole tokens of class, id or role whose elements are not article text, unless the page's article is in them.
LEFT_OUT_NAMES = frozenset("""ad ads advert adverts advertisement advertising adbox ad-box ad-container sponsor sponsored promo promotion banner
    cookie cookies cookie-notice cookie-banner cookie-bar cookie-consent consent gdpr popup modal overlay subscribe newsletter signup login
    sidebar side-bar widget widgets menu nav navbar navigation breadcrumb breadcrumbs pagination pager share sharing share-buttons social
    social-share social-links related related-posts related-articles recommended comment comments comments-area comment-list comment_list
    commentlist replies respond disqus disqus_thread footer site-footer page-footer masthead site-header topbar copyright""".split())
KNOWN = BLOCKS | VOID | LEFT_OUT | frozenset("a abbr b big cite code del em font i ins kbd mark q s samp small span strike strong sub sup tt u var".split())
MARKS = ("article", "main")
HEADINGS = ("h1", "h2", "h3")
# What no title holds.
NO_TITLE = ("nav", "ul", "ol", "form", "input", "table")
RUNNING = (KNOWN - BLOCKS) | frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol li dl dt dd".split())

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_QUOTED = re.compile(r"""((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_PLAIN = re.compile(r"([^>]*)>")
#: Tags of a page whose quotes do not close, after which quotes count for nothing in the rest of it.
BROKEN_QUOTES = 8
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_TELLING = re.compile(r"class|id|role|hidden|style", re.I)
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_CLOSES = {"p": BLOCKS - {"option"}, "li": {"li"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "dt": {"dt", "dd"},
           "dd": {"dt", "dd"}, "option": {"option"}}


class Token:
    """``words`` (text of a block's part, with its context) or a tag."""

    __slots__ = ("kind", "name", "text", "inside")

    def __init__(self, kind: str, name: str, text: str, inside: bool) -> None:
        self.kind, self.name, self.text, self.inside = kind, name, text, inside


def _tags(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """(start, end, is an end tag, name, attributes) of tags in page order; comments and declarations have no name.

    Every step moves on or is one of a fixed number of failures, so the time is linear in the page.
    """
    last, broken, at = page.rfind(">"), 0, 0
    while (start := page.find("<", at)) >= 0:
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            end = len(page) if end < 0 else end + 3
        elif start > last:
            # no tag ends after this place, but a comment may begin
            at = page.find("<!--", start)
            if at < 0:
                return
            continue
        elif page.startswith(("<!", "<?"), start):
            end = page.find(">", start) + 1
        else:
            name = _NAME.match(page, start)
            if name is None:
                at = start + 1
                continue
            rest = _QUOTED.match(page, name.end()) if broken < BROKEN_QUOTES else None
            if rest is None:
                broken += 1
                rest = _PLAIN.match(page, name.end())
            if rest is None:
                at = start + 1
                continue
            at = yield start, rest.end(), name[1] == "/", name[2].lower(), rest[1]
            at = at or rest.end()
            continue
        yield start, end, False, "", ""
        at = end


def _never_text(name: str) -> bool:
    return name != "form" and name in LEFT_OUT


def _in_doubt(name: str, attributes: str) -> bool:
    """Elements that are hidden or named as something else than text; a form is, too, as some pages are one."""
    if name == "form":
        return True
    if not attributes or name in ("body", "html", *MARKS) or not _TELLING.search(attributes):
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id", "role"):
            if (name in BLOCKS or name == "span") and not LEFT_OUT_NAMES.isdisjoint(value.split()):
                return True
        elif (key == "hidden" and value.strip() != "false") or (key == "aria-hidden" and value.strip() == "true") or \
                (key == "style" and _NO_DISPLAY.search(value)):
            return True
    return False


def _decide(found: list[Token], doubtful: list[tuple[int, int, str]]) -> list[Token]:
    """The tokens without those of doubtful elements (from, to, name).

    An element stays if it has all the marked articles of the page, or, on a page without any, more than half of
    the words; the scores then judge its words like all others.  A form stays for the former only.  A header inside
    the page also stays if it has a heading and no list, menu or form: the title of a text rather than the head of a site.
    """
    marks = [i for i, t in enumerate(found) if t.kind == "tag" and t.name in MARKS]
    words = [0, *itertools.accumulate(len(t.text.split()) for t in found)] if not marks else []
    headings, lists = ([0, *itertools.accumulate(t.kind == "tag" and t.name in names for t in found)] for names in (HEADINGS, NO_TITLE))
    gone = bytearray(len(found))
    reach = 0  # what is before this place and after the start of the present element is gone
    for start, end, name in sorted(doubtful, key=lambda d: (d[0], -d[1])):
        if end <= reach:
            continue
        if marks and start <= marks[0] and marks[-1] < end:
            continue
        if not marks and name != "form" and 2 * (words[end] - words[start]) > words[-1]:
            continue
        if name == "header" and headings[end] > headings[start] and lists[end] == lists[start]:
            continue
        gone[start:end] = b"\1" * (end - start)
        reach = end
    return [t for t, out in zip(found, gone) if not out]


class _Open:
    """The open elements: their names, and where each name and the blocks are, so that no step searches them all."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.of: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, name: str) -> None:
        self.of.setdefault(name, []).append(len(self.names))
        if name in BLOCKS:
            self.blocks.append(len(self.names))
        self.names.append(name)

    def pop(self) -> str:
        name = self.names.pop()
        self.of[name].pop()
        if name in BLOCKS:
            self.blocks.pop()
        return name

    def innermost(self, name: str) -> int:
        """Depth of the innermost open element of the name, or -1."""
        at = self.of.get(name)
        return at[-1] if at else -1

    def block_above(self, depth: int) -> bool:
        return bool(self.blocks) and self.blocks[-1] > depth


def tokens(page: str) -> list[Token]:
    """Words and tags in page order; ``inside`` tells whether a token is in a marked article."""
    out: list[Token] = []
    stack = _Open()
    skip = 0  # depth of the stack at which the element left out began
    marked = 0
    at = 0
    open_doubt: list[tuple[int, int, str]] = []  # depth of the stack, first token and name of doubtful elements that are open
    doubtful: list[tuple[int, int, str]] = []

    def text(raw: str) -> None:
        if raw and not skip:
            block = stack.names[stack.blocks[-1]] if stack.blocks else "body"
            link = "a" in stack.names[-3:]
            out.append(Token("words", f"{block if block in KNOWN else 'other'}{'/a' if link else ''}", raw, marked > 0))

    def close(depth: int) -> None:
        nonlocal skip, marked
        while len(stack.names) > depth:
            gone = stack.pop()
            marked -= gone in MARKS
            if skip > len(stack.names):
                skip = 0
            if open_doubt and open_doubt[-1][0] > len(stack.names):
                _, start, name = open_doubt.pop()
                doubtful.append((start, len(out), name))

    n = len(page)
    tags = _tags(page)
    tag = next(tags, None)
    while tag is not None:
        start, end, ends, name, attributes = tag
        text(page[at:start])
        at = end
        if not name:
            tag = next(tags, None)
            continue
        known = name if name in KNOWN else "other"
        if ends:
            low = stack.innermost(name)
            # an inline end tag does not reach out of its block
            if low >= 0 and (name in BLOCKS or not stack.block_above(low)):
                close(low)
            if not skip:
                out.append(Token("tag", f"/{known}", "", marked > 0))
            tag = next(tags, None)
            continue
        for open_name, by in _CLOSES.items():
            if name in by:
                low = stack.innermost(open_name)
                if low >= 0 and not stack.block_above(low):
                    close(low)
        if name in RAW:
            close_tag = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = close_tag.end() if close_tag else n
            if not skip:
                out.append(Token("tag", "out", "", marked > 0))
            try:
                tag = tags.send(at)
            except StopIteration:
                tag = None
            continue
        if not skip:
            out.append(Token("tag", known, "", marked > 0))
        if name not in VOID:
            top = not stack.names or stack.names[-1] in ("body", "html")
            marked += name in MARKS
            stack.push(name)
            if not skip:
                if _never_text(name) or (name == "header" and not marked and top):
                    skip = len(stack.names)
                elif _in_doubt(name, attributes or "") or (name == "header" and not marked):
                    open_doubt.append((len(stack.names), len(out), name))
        tag = next(tags, None)
    text(page[at:])
    close(0)
    return _decide(out, doubtful) if doubtful else out


def count_contexts(page: str) -> Counter | None:
    """(kind, name, inside) counts of a page that marks one article, else None."""
    found = tokens(page)
    starts = [t for t in found if t.kind == "tag" and t.name in MARKS]
    if len(starts) != 1:
        return None
    out: Counter = Counter()
    for t in found:
        out[t.kind, t.name, t.inside and t.name not in MARKS] += len(html.unescape(t.text).split()) if t.kind == "words" else 1
    return out


class Scores:
    """Score of a word or tag by its context, a log likelihood ratio with one added to each count."""

    def __init__(self, counts: dict[tuple[str, str, bool], int]) -> None:
        names = {(k, n) for k, n, _ in counts} | {("words", n) for n in ("p", "h1", "body")} | {("tag", "p")}
        total = {side: sum(v for (_, _, s), v in counts.items() if s == side) + len(names) for side in (True, False)}
        self.of = {}
        for kind, name in names:
            ratio = math.log((counts.get((kind, name, True), 0) + 1) / total[True]) - math.log((counts.get((kind, name, False), 0) + 1) / total[False])
            self.of[kind, name] = max(LEAST, min(ratio, TAG_MOST) if kind == "tag" else ratio)
        if not any(side for _, _, side in counts):
            self.of = {}

    def __call__(self, t: Token, n_words: int) -> float:
        """Contexts that were not seen: words count for, tags against, those of running text less."""
        if t.kind == "words":
            return n_words * self.of.get(("words", t.name), 1.0)
        return self.of.get(("tag", t.name), -0.2 if t.name.lstrip("/") in RUNNING else -3.0)


UNSEEN = Scores({})


def best_region(scores: list[float]) -> tuple[int, int]:
    """[from, to) of the contiguous run of the greatest sum above 0; (0, 0) if there is none."""
    best, at, run, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += s
        if run > best:
            best, at = run, (start, i + 1)
    return at


def main_text(page: str, scores: Scores) -> str:
    found = tokens(page)
    texts = [html.unescape(t.text) if t.kind == "words" else "" for t in found]
    words = [len(x.split()) for x in texts]
    start, end = best_region([scores(t, n) for t, n in zip(found, words)])
    if end == 0 and not any(t.name in MARKS for t in found if t.kind == "tag"):
        start, end = best_region([UNSEEN(t, n) for t, n in zip(found, words)])
    blocks, now = [], []
    for t, x in zip(found[start:end], texts[start:end]):
        if t.kind == "words":
            now.append(x)
        elif t.name.lstrip("/") in BLOCKS:
            blocks.append("".join(now))
            now = []
        elif t.name == "br":
            now.append(" ")
    blocks.append("".join(now))
    return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def fit(pages: DataFrame, sample: int = SAMPLE_PAGES) -> Scores:
    """Scores from the marked pages of a sample of ``sample`` pages, those of the least hash of their id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for page in b.column("html").to_pylist():
                counts.update(count_contexts(page or "") or {})
        rows = [(k, n, s, v) for (k, n, s), v in counts.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.bool_(), pa.int64()))],
                                         names=["kind", "name", "inside", "n"])

    h = F.xxhash64("page_id", "url")
    known = pages.where(F.col("html").isNotNull())
    n = known.count()
    # the share is a little above the sample; it is taken by hash, so it is spread over all tasks and needs no sort
    chosen = known.where(F.pmod(h, F.lit(1 << 40)) < F.lit(min(1 << 40, int((sample / max(n, 1)) * (1 << 40)))))
    rows = chosen.select("html").mapInArrow(run, "kind string, name string, inside boolean, n bigint")
    return Scores({(r["kind"], r["name"], r["inside"]): r["n"] for r in rows.groupBy("kind", "name", "inside").agg(F.sum("n").alias("n")).collect()})


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(fit(pages))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(page or "", shared.value) for page in batch.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                           pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", "html").mapInArrow(
        by_batch(work), f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
