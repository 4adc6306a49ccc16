"""Main-text extraction by line-block distribution.

Markup is stripped into lines of text, one per block element (empty ones make
none).  Every line has a text mass: its length without link text, nothing for
boilerplate (menus, page headers, footers, sidebars, notices, adverts, forms,
comments, hidden parts).  The masses of three consecutive lines are summed, as
are those of each run of lines with mass; where a sum surges over a threshold
the main text begins, with the first line of that run, and where the window sums
dive to nothing for the last time after a surge it ends.  The lines with mass between
are kept; those without (lines of links) are menus and teasers.  Without a surge it is the heaviest line and what reaches it over fewer
than three lines without mass.  A page that marks its article (article, main,
role=main) gives the lines inside it a mass above the threshold and the others
none, so the surge and dive points are the article's ends however short it is.

An element is hidden by the attribute ``hidden`` or ``aria-hidden`` or by
``display: none``, never by a word in another attribute.  Boilerplate names are
matched against whole class, id and role names, not against parts of them.

Cases: null or empty html gives an empty text, as does a page without text;
unclosed elements end with the page or with the next block of their kind, unclosed
raw elements (styles, drawings, frames) with any next block, only an unclosed script
with the page; ``.../>`` closes svg and math; head needs no end, as what it may hold
is raw or empty;
a quote that never closes is a character, a ``<name`` that never ends is text (one
forward scan, linear in the page);
a damaged character reference stays as it is; equal pages give equal texts;
texts of any length are read whole; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

WINDOW = 3              # lines summed
SURGE = 86              # characters in a window where text begins

# Element names of HTML.
RAW = set("script style noscript template svg math iframe object canvas audio video select textarea title".split())
RAW_TEXT = {"style", "title", "textarea", "iframe"}         # markup inside is text
BOILERPLATE = {"nav", "footer", "aside", "form", "menu", "dialog", "button"}
BLOCKS = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section
summary table tbody td tfoot th thead tr ul""".split())
ENDED_BY_BLOCK = {"p", "li", "dt", "dd", "h1", "h2", "h3", "h4", "h5", "h6", "td", "th", "tr"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Class, id and role names that mark boilerplate, also joined with each other (cookie-notice) or with an affix (site-footer).
MARKS = set("""ad ads adv advert advertisement adsense sponsor sponsored promo promotion banner sidebar side menu nav
navbar navigation breadcrumb breadcrumbs footer masthead topbar cookie cookies consent gdpr notice notification alert
popup modal overlay comment comments commentlist reply replies disqus discussion share sharing social related
recommended newsletter subscribe subscription signup login search pagination pager widget toolbar skip
complementary contentinfo""".split())
# Marks that are subjects too, so also the id of a section of the text: as an id they do not count.
TOPICS = set("""side menu navigation cookies consent gdpr notice notification alert reply replies discussion
share sharing social related recommended promotion sponsored advertisement newsletter subscription signup login search
""".split())
PREFIXES = {"site", "page", "main", "global", "top", "bottom", "primary", "secondary"}
SUFFIXES = {"list", "area", "body", "box", "container", "wrapper", "x"}
# Parts of a name that say what is listed or placed there; they go with any mark (related-posts, ad_slot).
PLACED = set("""article articles banner bar block button buttons card cards icon icons item items link links panel post
posts slot stories story teaser unit widget zone""".split())
TEASERS = {"card", "teaser", "preview"}         # of an article beside or after the text's own
COMMENTS = {"comment", "comments", "commentlist", "reply", "replies"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

_OPEN = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][\w:-]*))")
_STOP = re.compile("[>\"']")
_SCRIPT_END = re.compile(r"</script\s*>", re.I)
_SAME = {name: re.compile(rf"<(?:(/){name}\s*>|{name}\b)", re.I) for name in RAW_TEXT}
_ATTRS = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""")
_NONE = re.compile(r"display\s*:\s*none", re.I)
_WORDS = re.compile(r"[^\W\d_]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_BLOCK = re.compile(rf"</?(?:{'|'.join(sorted(BLOCKS))})(?![\w:-])", re.I)
_ROLE_MAIN = re.compile(r"""\brole\s*=\s*["']?main\b""", re.I)


def _is_mark(token: str, as_id: bool, marks: set[str]) -> bool:
    """Whether a whole class, id or role name stands for boilerplate."""
    words = _WORDS.findall(_CAMEL.sub(" ", token).lower())
    if len(words) > 1 and len(words[0]) == 1:        # c-promo, u-hidden: kinds of classes
        words = words[1:]
    placed = len(words) > 1 and words[-1] in PLACED and words[-1] not in marks
    if placed:
        words = words[:-1]
    core = words
    if len(core) > 1 and core[0] in PREFIXES:
        core = core[1:]
    if len(core) > 1 and core[-1] in SUFFIXES:
        core = core[:-1]
    if not core or not marks.issuperset(core):
        return False
    if core is not words and not placed:             # page-search, sidebar-wrapper: of a whole page or layout
        return not (TOPICS | {"sidebar"}).issuperset(core)
    return not (as_id and len(core) == 1 and not placed and TOPICS.issuperset(core))


def _is_teaser(attrs: str) -> bool:
    """Whether an article's class says that it stands for another page."""
    for m in _ATTRS.finditer(attrs):
        if m.group(1).lower() == "class":
            return any(not TEASERS.isdisjoint(_WORDS.findall(_CAMEL.sub(" ", t).lower()))
                       for t in (m.group(2) or "").strip("\"'").split())
    return False


def _marked(name: str, attrs: str, in_article: bool, skipped: bool = False) -> bool:
    """Whether an element is hidden or boilerplate by its attributes.  Names do
    not count for article and main (except comments in an article and what is
    ``skipped``), nor for headings in an article."""
    if not attrs:
        return False
    marks = MARKS
    if name in ("article", "main") and not skipped:
        marks = COMMENTS if in_article else ()
    elif name in HEADINGS and in_article:
        marks = ()
    for m in _ATTRS.finditer(attrs):
        key, value = m.group(1).lower(), (m.group(2) or "").strip("\"'/ ")
        if key == "hidden" and value.lower() != "false" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "style" and _NONE.search(value):
            return True
        if marks and key in ("class", "id", "role"):
            if any(_is_mark(t, key == "id", marks) for t in value.split()):
                return True
    return False


class _Scanner:
    """Comments and tags of a page from left to right, in linear time however the
    page is damaged.  A quote that never closes is a plain character.  A ``<name``
    whose tag never ends is text; the quotes that such a scan passed are noted, as
    any later scan that reaches one of them cannot end either."""

    def __init__(self, page: str):
        self.page, self.at = page, 0
        self.last = {c: page.rfind(c) for c in "\"'>"}
        self.dead: set[int] = set()
        self.first = (0, -1, None)                   # from, to: where the next stop is known

    def _stop(self, pos: int) -> re.Match | None:
        lo, hi, stop = self.first
        if not lo <= pos <= hi:
            stop = _STOP.search(self.page, pos)
            self.first = (pos, stop.start() if stop else len(self.page), stop)
        return stop

    def _tag_end(self, pos: int) -> int:
        """End of the tag whose attributes begin at ``pos``, or -1."""
        passed, stop = [], self._stop(pos) if pos <= self.last[">"] else None
        while stop:
            q = stop.start()
            if stop.group() == ">":
                return q + 1
            if q in self.dead:
                break
            passed.append(q)
            after = q + 1 if q >= self.last[stop.group()] else self.page.find(stop.group(), q + 1) + 1
            stop = _STOP.search(self.page, after) if after <= self.last[">"] else None
        self.dead.update(passed)
        return -1

    def __iter__(self):
        return self

    def __next__(self) -> tuple[int, int, str, bool, str]:
        """start, end, name in lower case (empty for comments and declarations), closing, attributes."""
        while m := _OPEN.search(self.page, self.at):
            comment, other, closing, name = m.groups()
            if comment:
                end = self.page.find("-->", m.end()) + 3
                end = len(self.page) if end == 2 else end
            elif other:
                end = self.page.find(">", m.end()) + 1 if m.end() <= self.last[">"] else 0
            else:
                end = self._tag_end(m.end())
            if end <= 0:
                self.at = m.end()
                continue
            self.at = end
            return m.start(), end, (name or "").lower(), bool(closing), self.page[m.end():end - 1] if name else ""
        raise StopIteration


def _without_raw(page: str) -> str:
    """The page without scripts, styles, drawings and the like.  An opening tag
    goes with the next closing one of its name (nested ones pair up); one that is
    never closed goes with what stands before the next block."""
    cuts, opened, unclosed = [], {}, set()           # [start, end, closed]
    tags = _Scanner(page)
    for start, end, name, closing, attrs in tags:
        if name not in RAW or name in ("svg", "math") and attrs.endswith("/") and not closing:
            continue
        if not closing and name == "script":
            close = _SCRIPT_END.search(page, end)
            tags.at = close.end() if close else len(page)
            cuts.append([start, tags.at, True])
            continue
        if not closing and name in _SAME:
            same = None if name in unclosed else _SAME[name].search(page, end)
            if same and same.group(1):
                tags.at = same.end()
                cuts.append([start, tags.at, True])
                continue
            if not same:
                unclosed.add(name)                   # nor will any later one close
        if not closing:
            cut = [start, end, False]
            cuts.append(cut)
            opened.setdefault(name, []).append(cut)
        elif opened.get(name):
            opened[name].pop()[1:] = end, True
    kept, at = [], 0
    for start, end, closed in cuts:
        if start < at:
            continue
        if not closed:
            block = _BLOCK.search(page, end)
            end = block.start() if block else len(page)
        kept.append(page[at:start])
        at = end
    return " ".join(kept + [page[at:]])


class _Lines:
    """Walk over the markup: lines as (text, characters of link text, in a marked article)."""

    def __init__(self, page: str):
        self.lines, self.parts, self.link_chars = [], [], 0
        self.article, self.link, self.has_article = 0, 0, False
        self.skipped, self.depth = "", 0          # boilerplate element that is open, and its nesting
        page, at = _without_raw(page), 0
        for start, end, name, closing, attrs in _Scanner(page):
            if start > at:
                self.text(page[at:start])
            at = end
            if name:
                self.tag(name, closing, attrs)
        self.text(page[at:])
        self.end_line()

    def text(self, raw: str) -> None:
        if not self.skipped:
            t = entities.unescape(raw)
            self.parts.append(t)
            if self.link:
                self.link_chars += len(t.strip())

    def end_line(self) -> None:
        t = " ".join("".join(self.parts).split())
        if t:
            self.lines.append((t, self.link_chars, self.article > 0))
        self.parts, self.link_chars = [], 0

    def tag(self, name: str, closing: bool, attrs: str) -> None:
        if self.skipped:
            marked_main = name in ("article", "main") and not closing and not _marked(
                name, attrs, False, skipped=True)
            if marked_main or self.skipped in ENDED_BY_BLOCK and name in BLOCKS and not (
                    name == self.skipped and closing):
                self.skipped = ""
            else:
                if name == self.skipped and not attrs.endswith("/"):
                    self.depth += -1 if closing else 1
                    if not self.depth:
                        self.skipped = ""
                return
        if name in BLOCKS or name in BOILERPLATE:
            self.end_line()
        if name == "br":
            self.parts.append(" ")
        if not closing and name not in VOID and not attrs.endswith("/"):
            page_header = name == "header" and not self.article
            teaser = name == "article" and self.has_article and _is_teaser(attrs)
            if name in BOILERPLATE or page_header or teaser or name not in ("html", "body") and _marked(
                    name, attrs, self.article > 0):
                self.skipped, self.depth = name, 1
                return
        if name in ("article", "main") or _ROLE_MAIN.search(attrs):
            self.article = max(0, self.article + (-1 if closing else 1))
            self.has_article |= name == "article" and closing
        if name == "a":
            self.link = 0 if closing else 1


def _main_range(mass: list[int]) -> tuple[int, int]:
    """[first surge, last dive) of the lines, widened to whole runs."""
    n = len(mass)
    sums = [sum(mass[k:k + WINDOW]) for k in range(n)]
    runs, k = [], 0                                  # runs of lines with mass
    while k < n:
        b = k
        while b < n and mass[b]:
            b += 1
        if b > k:
            runs.append((k, b))
        k = b + 1
    surges = [(a, b) for a, b in runs
              if sum(mass[a:b]) >= SURGE or any(sums[k] >= SURGE for k in range(a, b))]
    if surges:
        first, last = surges[0][0], surges[-1][1]
    elif runs:                                       # the heaviest line and what reaches it
        first = last = max(range(n), key=mass.__getitem__)
        for a, b in reversed(runs):
            if b <= first and first - b < WINDOW or a <= first < b:
                first = a
    else:
        return 0, 0
    for a, b in runs:                                # on to the dive
        if a <= last or a - last < WINDOW:
            last = max(last, b)
    return first, last


def main_text(page: str | None) -> str:
    lines = _Lines(page or "").lines
    in_article = any(a for _, _, a in lines)
    if in_article:
        mass = [SURGE + len(t) if a else 0 for t, _, a in lines]
    else:
        mass = [max(0, len(t) - k) if 2 * k <= len(t) else 0 for t, k, _ in lines]
    first, last = _main_range(mass)
    return " ".join(lines[k][0] for k in range(first, last) if mass[k])


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` (all columns but the html) with text and n_chars."""
    @F.pandas_udf("string")
    def text_of(col: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in col], dtype=object)

    keep = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    return (small_batches(pages).select(*keep, text_of(F.col(html_col)).alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
