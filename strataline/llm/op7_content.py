"""Main text of web pages by the maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive, by the block and link they stand in, tags negative, by
their name, with weights learned from pages that label their content themselves (an ``article`` or ``main``
element): the log odds of the token inside against outside. One linear scan finds the contiguous region with the
highest sum. What is never main text (scripts, forms, navigation, notices, comments) has its own tag weight, and its
words neither score nor come out; an element named as such that holds the page's content is taken like any other.
"""

from __future__ import annotations

import html as html_entities
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import map_arrow, only

TRAIN_PAGES = 2000  # pages the weights are learned from, about: the bound of the training sample
LEAST_WORD, MOST_WORD = 0.25, 3.0
LEAST_TAG, MOST_TAG = 0.05, 2.0

# HTML's element names by the part they play.
UNSHOWN = frozenset("script style template noscript svg math iframe object head title textarea select button option canvas "
                    "audio video map".split())
CHROME = frozenset("nav header footer aside form menu dialog fieldset search".split())
CONTENT = frozenset("article main".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p "
                  "pre search section summary table tbody td tfoot th thead title tr ul".split())
CLOSES_P = BLOCK - {"br", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "dt", "dd", "option", "head", "title", "html", "body"}
# Words of class, id and role attributes. A name marks chrome if it consists of words of these lists only (no-sidebar and
# has-header say something about a page or a post), or if it has a word of CHROME_PARTS and none that tells a state.
CHROME_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promotions comment "
    "comments commentlist disqus respond reply replies sidebar side rail widget widgets nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs header masthead footer foot cookie cookies consent gdpr notice notices notification alert popup modal "
    "overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "pagination pager toolbar complementary contentinfo search form".split())
COMMENT_NAMES = frozenset("comment comments commentlist disqus respond reply replies".split())
CHROME_PARTS = COMMENT_NAMES | frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo sidebar widget widgets nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs footer cookie cookies consent gdpr popup newsletter subscribe share sharing "
    "social related recommended recommendations pagination pager toolbar".split())
STATES = frozenset(
    "no not has have is with without open opened closed enabled disabled active inactive on off free hide hidden show shows "
    "allow allows supports ready count counter".split())
STRUCTURE = frozenset(
    "area bar block body bottom box button buttons col column container content foot frame global icon icons inner item items left "
    "link links list main outer page panel post posts primary right row secondary section site slot text thread title top unit "
    "wrap wrapper x article articles story stories".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(?P<lname>/?[A-Za-z][A-Za-z0-9:-]*)(?P<lrest>[^>]*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S)
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in ("script", "style", "textarea", "title", "noscript", "iframe", "template")}
_ATTRIBUTE = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_NAME_PART = re.compile(r"[a-z]+")
_MAY_HIDE = re.compile(r"\b(?:class|id|role)\s*=|<(?:" + "|".join(sorted(CHROME)) + r")\b", re.I)


def _has_chrome_part(parts: set[str], wanted: frozenset[str]) -> bool:
    """Whether one of the parts is a wanted word, or one written together with a word of structure or another of chrome."""
    return bool(parts & wanted) or any(
        part[:k] in wanted and (part[k:] in STRUCTURE or part[k:] in CHROME_NAMES)
        or part[k:] in wanted and (part[:k] in STRUCTURE or part[:k] in CHROME_NAMES)
        for part in parts for k in range(2, min(len(part), 24) - 1))


def _named(name: str, rest: str) -> str:
    """``chrome`` or ``comments`` if a name among an element's attributes says so, else an empty text."""
    if not rest or name in ("html", "body") or name in CONTENT:
        return ""
    found = ""
    for values in _ATTRIBUTE.findall(rest):
        for whole in "".join(values).split():
            parts = set(_NAME_PART.findall(_CAMEL.sub("-", whole).lower()))
            only_known = bool(parts & CHROME_NAMES) and parts <= CHROME_NAMES | STRUCTURE - {"article", "articles", "story", "stories"}
            if only_known or not parts & STATES and _has_chrome_part(parts, CHROME_PARTS):
                if _has_chrome_part(parts, COMMENT_NAMES):
                    return "comments"
                found = "chrome"
    return found


def _spared(page: str) -> frozenset[int]:
    """Begins of elements of chrome, by tag or by name, that hold what the page is about: its largest content element
    outside comments or, where it has none, over half of its shown words (comments never do)."""
    if not _MAY_HIDE.search(page):
        return frozenset()
    spans: list[tuple[str, int, int, int]] = []
    total = sum(len(value.split()) for kind, value, _ in _walk(page, None, spans) if kind.startswith("word:"))
    remarks, latest = [], -1  # begins and ends of outermost comments, in page order
    for name, begin, end, _ in sorted(spans, key=lambda span: span[1]):
        if name == "comments" and begin > latest:
            remarks.append((begin, end))
            latest = end

    def remark(begin: int) -> bool:
        at = bisect_right(remarks, (begin, math.inf)) - 1
        return at >= 0 and begin < remarks[at][1]

    content = max((span for span in spans if span[0] in CONTENT and not remark(span[1])), key=lambda span: span[3], default=None)
    return frozenset(
        begin for name, begin, end, words in spans if name not in CONTENT and
        (begin < content[1] and content[2] <= end if content else name != "comments" and 2 * words > total))


def tokens(page: str) -> Iterator[tuple[str, str, bool]]:
    """``(kind, value, labelled)`` in page order: kind is ``tag:NAME`` for a tag, ``word:BLOCK`` or ``word:link`` for
    a run of shown text (value: the text, references decoded), ``skip`` for text that is never main text; labelled
    tells whether it is inside the page's own content element. Unclosed elements end with their parent."""
    return _walk(page, _spared(page))


def _walk(page: str, spared: frozenset[int] | None, spans: list[tuple[str, int, int, int]] | None = None,
          ) -> Iterator[tuple[str, str, bool]]:
    """The tokens; elements that begin at ``spared`` are not hidden as chrome (None: no element is). ``spans`` gets name,
    begin, end and words of content elements and, as ``chrome`` or ``comments``, of elements of chrome. What a token needs
    to know of the open elements stands on the innermost one, so deep pages take no longer."""
    stack: list[tuple[str, bool, bool, str, bool]] = []  # name, hides its text, in content, block, in a link
    depth_of: Counter[str] = Counter()  # open elements by name
    opened: list[tuple[int, str, int, int]] = []  # depth, name, begin and words before, of elements for spans
    at, end, words = 0, len(page), 0

    def close(depth: int, here: int) -> None:
        for name, *_ in stack[depth:]:
            depth_of[name] -= 1
        del stack[depth:]
        while opened and opened[-1][0] >= depth:
            _, name, begin, before = opened.pop()
            spans.append((name, begin, here, words - before))

    while at < end:
        match = _TOKEN.match(page, at)
        begin, at = at, match.end()
        _, hides, inside, block, link = stack[-1] if stack else ("", False, False, "none", False)
        text = match["text"]
        if text is not None:
            if hides:
                continue
            words += len(text.split()) if spans is not None else 0
            yield ("word:link" if link else f"word:{block}"), html_entities.unescape(text), inside
            continue
        name = (match["name"] or (match["lname"] or "").lstrip("/")).lower()
        if not name:
            continue
        rest = match["rest"] if match["name"] else match["lrest"]
        closing = bool(match["close"]) or bool(match["lname"] and match["lname"].startswith("/"))
        if closing:
            if not depth_of[name]:
                continue
            depth = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name)
            hidden = stack[depth][1]
            label = "tag:chrome" if hidden and depth and not stack[depth - 1][1] else f"tag:{name}"
            close(depth, at)
            if not hidden or not (stack and stack[-1][1]):
                yield label, name, inside
            continue
        if name in CLOSES_P and depth_of["p"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    close(i, begin)
                    break
                if stack[i][0] in BLOCK:
                    break
        elif name in ("li", "dt", "dd", "tr", "td", "th", "option"):
            same = ("dt", "dd") if name in ("dt", "dd") else ("td", "th") if name in ("td", "th") else (name,)
            for i in range(len(stack) - 1, -1, -1) if any(depth_of[n] for n in same) else ():
                if stack[i][0] in same:
                    close(i, begin)
                    break
                if stack[i][0] in ("ul", "ol", "dl", "table", "select", "tr" if name in ("td", "th") else "table"):
                    break
        _, hides, inside, block, link = stack[-1] if stack else ("", False, False, "none", False)
        named = _named(name, rest)
        # An article's own header is its title; elsewhere it is the page's.
        by_tag = name in CHROME and not (name == "header" and inside)
        chrome = bool(by_tag or named) and spared is not None and begin not in spared
        within = inside or name in CONTENT
        if not hides:
            yield ("tag:chrome" if chrome else f"tag:{name}"), name, within
        if name in VOID or rest.rstrip().endswith("/") and name not in BLOCK:
            continue
        if name in _RAW_END:
            closed = _RAW_END[name].search(page, at)
            at = closed.end() if closed else end
            continue
        if spans is not None and not hides and (named or by_tag or name in CONTENT):
            opened.append((len(stack), name if name in CONTENT else named or "chrome", begin, words))
        stack.append((name, hides or chrome or name in UNSHOWN, within and not chrome, name if name in BLOCK else block, link or name == "a"))
        depth_of[name] += 1
    close(0, end)


def counts(page: str) -> Counter:
    """``(kind, labelled)`` counts of a page's tags and words; empty for a page that labels no content."""
    seen: Counter = Counter()
    labelled = False
    for kind, value, inside in tokens(page):
        labelled |= inside
        seen[kind, inside] += len(value.split()) if kind.startswith("word:") else 1
    return seen if labelled else Counter()


def fit(pages: DataFrame, id_column: str = "page_id", html_column: str = "html", train_pages: int = TRAIN_PAGES) -> dict[str, float]:
    """Weights by token kind from about ``train_pages`` pages, chosen by hash. The driver gets a row per kind, of
    which HTML's element names make a bounded number (others count as ``other``)."""
    known = only(pages, [id_column, html_column]).where(F.col(f"`{html_column}`").isNotNull())
    total = known.count()
    draw = F.pmod(F.xxhash64(F.lit("train"), f"`{id_column}`", F.hash(f"`{html_column}`")), F.lit(1_000_000))
    sample = known.where(draw < -(-train_pages * 1_000_000 // max(1, total))).select(F.col(f"`{html_column}`").alias("html"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for page in batch.column(0):
                for (kind, inside), n in counts(page.as_py()).items():
                    name = kind.partition(":")[2]
                    plain = name in BLOCK or name in VOID or name in ("a", "b", "i", "em", "strong", "span", "link", "chrome", "none")
                    seen[kind if plain else kind.partition(":")[0] + ":other", inside] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in seen]), pa.array([i for _, i in seen], pa.bool_()), pa.array(list(seen.values()), pa.int64())],
                ["kind", "inside", "n"])

    rows = map_arrow(sample, count, "kind string, inside boolean, n long").groupBy("kind", "inside").agg(F.sum("n").alias("n")).collect()
    return weights({(r.kind, r.inside): r.n for r in rows})


def weights(seen: Mapping[tuple[str, bool], int]) -> dict[str, float]:
    """Log odds of each kind inside against outside content, from its own rate among words or tags. Words keep to
    positive and tags to negative values."""
    out = {}
    for family, sign, least, most in (("word:", 1, LEAST_WORD, MOST_WORD), ("tag:", -1, LEAST_TAG, MOST_TAG)):
        kinds = {k for k, _ in seen if k.startswith(family)}
        for kind in kinds:
            odds = math.log((seen.get((kind, True), 0) + 0.5) / (seen.get((kind, False), 0) + 0.5))
            out[kind] = sign * min(most, max(least, sign * odds if sign > 0 else -odds / 2))
    return out


DEFAULT = {"word:p": 2.0, "word:link": LEAST_WORD, "word:li": 0.5, "word:other": 1.0, "tag:p": -LEAST_TAG, "tag:a": -0.5,
           "tag:li": -1.0, "tag:chrome": -2.0, "tag:other": -0.3}


def extract(page: str | None, weight: Mapping[str, float]) -> str:
    """The text of the best region: block by block, white space as one space, trimmed, joined by a space. Of regions
    with equal sums the earliest and then longest wins. No words give an empty text."""
    if not page:
        return ""
    items = list(tokens(page))
    default = {f: weight.get(f + "other", DEFAULT[f + "other"]) for f in ("word:", "tag:")}
    best = total = 0.0
    start, region = 0, (0, 0)
    for i, (kind, value, _) in enumerate(items):
        if total <= 0:
            total, start = 0.0, i
        family = "word:" if kind.startswith("word:") else "tag:"
        score = weight.get(kind, DEFAULT.get(kind, default[family]))
        total += score * len(value.split()) if family == "word:" else score
        if total > best or total == best and total > 0 and region[0] == start:
            best, region = total, (start, i + 1)
    out = []
    for kind, value, _ in items[region[0]:region[1]]:
        if kind.startswith("word:"):
            out.append(value)
        elif value in BLOCK:
            out.append("\n")
    return " ".join("".join(out).split())


def main_text(pages: DataFrame, weight: Mapping[str, float] | None = None, id_column: str = "page_id",
              url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One row per page: ``id_column``, ``url_column``, ``text``, ``n_chars`` (code points).

    Without ``weight`` the weights are learned from the pages themselves; pages that don't label their content are
    extracted like any other, and where none does, fixed default weights serve. Null and empty pages and pages
    without words give an empty text. An empty table gives no rows; other columns are ignored.
    """
    if weight is None:
        weight = {**DEFAULT, **fit(pages, id_column, html_column)}
    chosen = only(pages, [id_column, url_column, html_column])
    id_kind, url_kind, _ = (f.dataType.simpleString() for f in chosen.schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [extract(page.as_py(), weight) for page in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    [id_column, url_column, "text", "n_chars"])

    return map_arrow(chosen, work, f"`{id_column}` {id_kind}, `{url_column}` {url_kind}, text string, n_chars long")
