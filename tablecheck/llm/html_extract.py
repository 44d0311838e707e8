"""The main text of web pages: the best-scoring run of words and tags."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.llm.common import in_batches, ship

#: Labelled pages that the weights are learned from, and the longest of them in code points.
FIT_PAGES, FIT_LONGEST = 1000, 50_000
#: Weights lie within this range.
MOST = 4.0
#: A tag whose quotes are not closed within so many code points ends at the next `>`.
LONGEST_TAG = 1024

# Element names of HTML and usual names of parts that are no article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i img ins kbd mark math mi mn mo mrow ms msqrt mfrac msub msup "
    "mtext q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split()
)
BOILERPLATE = frozenset(
    "head nav footer aside form script style noscript template iframe button select option textarea svg menu dialog".split()
)
RAW = frozenset("script style noscript textarea title iframe".split())
#: Names of parts by a class or id, as a whole or with one of AROUND before or after.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adbox sponsor sponsored promo promotion banner sidebar side menu "
    "nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar cookie cookies consent notice notices gdpr popup modal overlay "
    "comment comments commentlist respond reply replies disqus share sharing social related recommended newsletter "
    "subscribe subscription signup login search widget toolbar pagination pager copyright skip".split()
)
AROUND = frozenset(
    "area bar block bottom box buttons container content footer form global inner left links list main outer page post "
    "posts primary right row secondary section site slot thread top unit widget wrap wrapper".split()
)
ADS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored".split())
#: Inside an article only these say that a part is none of it; the other names may be its subject.
IN_ARTICLE = frozenset(
    "ad ads advert adverts advertisement adbox sponsored sidebar side-bar nav navbar navigation breadcrumb breadcrumbs "
    "comments comment-list commentlist comment-section comments-section comments-area respond disqus disqus_thread "
    "share share-buttons sharing social-share related related-posts related-articles recommended newsletter "
    "newsletter-signup cookie-banner cookie-notice cookie-consent pagination".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu".split())
MAIN = frozenset(("article", "main"))

_TAG = re.compile(r"""<(/?)([a-zA-Z][\w:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_OPEN = re.compile(r"</?([a-zA-Z][\w:-]*)")
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
_NAMED = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)


def _tokens(page: str) -> Iterator[tuple[str, bool, str, str]]:
    """(name, whether it ends an element, attributes, '') of each tag and ('', False, '', text) of
    each run of text. Comments, declarations and the contents of raw elements are left out.

    The page is gone through once: a tag that has no end within LONGEST_TAG ends at the next `>`,
    and from where there is no `>` any more all is text."""
    at, last = 0, page.rfind(">")
    while at < len(page):
        begin = page.find("<", at)
        if begin < 0 or begin > last:
            yield "", False, "", page[at:]
            return
        if begin > at:
            yield "", False, "", page[at:begin]
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = len(page) if end < 0 else end + 3
            continue
        m = _TAG.match(page, begin, begin + LONGEST_TAG)
        opened = m or _OPEN.match(page, begin)
        if not opened:
            if page[begin + 1 : begin + 2] in ("!", "?", "/"):
                at = page.find(">", begin) + 1
            else:
                yield "", False, "", "<"
                at = begin + 1
            continue
        end = m.end() if m else page.find(">", begin) + 1
        if m:
            closing, name, attributes = bool(m[1]), m[2].lower(), m[3]
        else:
            closing, name, attributes = page[begin + 1] == "/", opened[1].lower(), page[opened.end() : end - 1]
        at = end
        if name in RAW and not closing:
            found = _RAW_END[name].search(page, end)
            at = found.end() if found else len(page)
            continue
        yield name, closing, attributes, ""


def _is_part(value: str, inside: bool) -> bool:
    """Whether a class or id names a part that is no article: as a whole, not by a word in it."""
    whole, parts = (IN_ARTICLE, ADS) if inside else (NAMES, NAMES)
    for name in value.split():
        words = [w for w in re.split(r"[_-]+", name) if w]
        if name in whole or not parts.isdisjoint(words) and all(w in parts or w in AROUND for w in words):
            return True
    return False


def _no_article(name: str, attributes: str, inside: bool) -> str:
    """Why an element is no article: `hard`, by what it is; `named`, by a class or id; or ''.

    Inside an article a header holds its title, and only unmistakable names count."""
    if name in BOILERPLATE or name == "header" and not inside:
        return "hard"
    if "=" not in attributes and "hidden" not in attributes.lower():
        return ""
    for m in _NAMED.finditer(attributes):
        kind, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if kind == "role" and value in ROLES or kind == "hidden" or kind == "aria-hidden" and value == "true":
            return "hard"
        if kind in ("class", "id") and name not in ("html", "body") and name not in MAIN and _is_part(value, inside):
            return "named"
    return ""


def units(page: str) -> list[tuple[str, str, int]]:
    """(type, raw text, words) for each run of text and (type, '', element) for each tag, in page
    order; `element` numbers the element that an article or main element lies in.

    The type of a text says where it stands: `skip` below a part that is no article, `link`
    in a link, `in` or `out` of an article element, `free` on a page without one. Tags of a
    part that is no article are `skip` too, and the inline ones are left out. A part that is
    never closed ends with what it lies in.

    A class or id around an outermost article or main does not make it no article."""
    out: list[tuple[str, str, int]] = []
    stack: list[tuple[str, int, tuple[int, int, int, int]]] = []  # open elements, and what held before each
    open_names: Counter = Counter()
    hard = named = inside = links = count = 0
    has_main = re.search(r"<(?:article|main)\b", page, re.I) is not None

    def cut(to: int) -> None:
        nonlocal hard, named, inside, links
        hard, named, inside, links = stack[to][2]
        open_names.subtract(x for x, _, _ in stack[to:])
        del stack[to:]

    def tag(kind: str, element: int = 0) -> None:
        if not (hard or named):
            out.append((kind, "", element))
        elif kind.lstrip("/") not in INLINE:
            out.append(("skip", "", 0))

    for name, closing, attributes, text in _tokens(page):
        if not name:
            place = "skip" if hard or named else "link" if links else "in" if inside else "out" if has_main else "free"
            out.append((place, text, len(text.split())))
            continue
        if closing:
            tag(f"/{name}")
            if not open_names[name]:
                continue
            at = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name)
            if not (name in INLINE and any(x not in INLINE for x, _, _ in stack[at:])):
                cut(at)
            continue
        if name not in INLINE:  # a block ends an open paragraph, an item ends an open item
            for k in range(len(stack) - 1, -1, -1):
                open_name = stack[k][0]
                if open_name == "p" or open_name == name and name in ("li", "dt", "dd", "tr", "td", "th"):
                    cut(k)
                    break
                if open_name not in INLINE:
                    break
        if name in VOID or attributes.endswith("/"):
            tag(name)
            continue
        skip = _no_article(name, attributes, inside > 0)
        parent = next((n for x, n, _ in reversed(stack) if x not in INLINE), 0) if name in MAIN else 0
        count += 1
        open_names[name] += 1
        stack.append((name, count, (hard, named, inside, links)))
        if name in MAIN and not inside:
            named = 0
        hard, named = hard + (skip == "hard"), named + (skip == "named")
        inside += name in MAIN
        links += name == "a"
        tag(name, parent)
    return out


def learn(pages: list[str]) -> dict[str, float]:
    """Log odds of each type for standing inside the article of labelled pages, which are those
    that mark it by an article or main element. Words of the article score positive at least
    a little, all tags and other words negative, skipped parts nothing. Types never seen take the default ones."""
    within, beyond = Counter(), Counter()
    for page in pages:
        found = units(page)
        spots = [k for k, (kind, _, n) in enumerate(found) if kind in ("in", "link") and n]
        marks = [k for k, (kind, _, _) in enumerate(found) if kind.lstrip("/") in MAIN]
        if not spots or len(marks) < 2:
            continue
        for k, (kind, raw, n) in enumerate(found):
            if raw and not n:
                continue
            (within if marks[0] <= k <= marks[-1] else beyond)[kind] += n if raw else 1
    a, b = sum(within.values()) + 1, sum(beyond.values()) + 1
    weights = dict(DEFAULT)
    for kind in within.keys() | beyond.keys():
        odds = math.log((within[kind] + 0.5) / a) - math.log((beyond[kind] + 0.5) / b)
        odds = max(-MOST, min(MOST, odds))
        if kind == "in":
            weights[kind] = max(0.5, odds)
        elif kind == "skip":  # cut out of any region anyway
            weights[kind] = 0.0
        elif kind == "out" or kind not in DEFAULT:
            weights[kind] = min(-0.05, odds)
    return weights


#: Weights of texts, and under "" of tags, that no labelled page shows.
DEFAULT = {"in": 1.0, "free": 1.0, "link": 0.2, "out": -1.0, "skip": 0.0, "": -0.5}


def best_region(found: list[tuple[str, str, int]], weights: dict[str, float]) -> tuple[int, int]:
    """The contiguous run with the largest score, by one linear scan; the first of equals."""
    best, best_at, score, begin = 0.0, (0, 0), 0.0, 0
    for k, (kind, raw, n) in enumerate(found):
        weight = weights.get(kind, weights[""])
        if score <= 0:
            score, begin = 0.0, k
        score += weight * n if raw else weight
        if score > best:
            best, best_at = score, (begin, k + 1)
    return best_at


def whole_article(found: list[tuple[str, str, int]], begin: int, end: int) -> tuple[int, int]:
    """The run, extended to the smallest article or main element that holds all its words of
    articles, where none does to all those that hold some; and to the articles beside these, in
    the same element."""
    held = [k for k in range(begin, end) if found[k][0] in ("in", "link") and found[k][2]]
    if not held:
        return begin, end
    spans, opened = [], []
    for k, (kind, raw, _) in enumerate(found):
        if raw or kind.lstrip("/") not in MAIN:
            continue
        if kind in MAIN:
            opened.append((kind, k))
            continue
        at = next((i for i in range(len(opened) - 1, -1, -1) if opened[i][0] == kind[1:]), None)
        if at is not None:
            spans += [(b, k + 1) for _, b in opened[at:]]
            del opened[at:]
    spans += [(b, len(found)) for _, b in opened]
    around = [(b, e) for b, e in spans if b <= held[0] and held[-1] < e]
    if around:
        around = [min(around, key=lambda s: s[1] - s[0])]
    else:
        around = [(b, e) for b, e in spans if any(b <= k < e for k in (held[0], held[-1]))]
    parents = {found[b][2] for b, _ in around if found[b][0] == "article"}
    around += [(b, e) for b, e in spans if found[b][0] == "article" and found[b][2] in parents]
    return min([begin, *(b for b, _ in around)]), max([end, *(e for _, e in around)])


def extract(page: str, weights: dict[str, float]) -> str:
    """Blocks of the best region, with all of the article that it lies in, joined by line breaks; parts that are no article are left out."""
    found = units(page)
    begin, end = whole_article(found, *best_region(found, weights))
    blocks, held = [], []

    def close() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            blocks.append(text)

    for kind, raw, _ in found[begin:end]:
        if raw:
            if kind not in ("skip", "out"):
                held.append(raw)
        elif kind.lstrip("/") not in INLINE:
            close()
        elif kind == "br":
            held.append(" ")
    close()
    return "\n".join(blocks)


def fit(pages: DataFrame, most: int = FIT_PAGES, longest: int = FIT_LONGEST) -> dict[str, float]:
    """Weights from at most `most` labelled pages of at most `longest` code points, chosen by
    hash from all pages."""
    labelled = pages.filter((F.length("html") <= longest) & F.lower("html").rlike("<(article|main)[ >]"))
    labelled = labelled.select("html", F.xxhash64("page_id", "url", "html").alias("h"))
    edge, below = labelled.select("h").orderBy("h").limit(most).agg(F.max("h"), F.count("*")).first()
    if edge is None:
        return dict(DEFAULT)
    # rows with the hash at the edge are one page, so it does not matter which of them are taken
    first = [r.html for r in labelled.filter(F.col("h") < edge).select("html").toLocalIterator()]
    at_edge = labelled.filter(F.col("h") == edge).select("html").limit(below - len(first)).collect()
    return learn(first + [r.html for r in at_edge])


def main_text(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(page_id, url, text): the main text of every whole page, in one pass without a shuffle.

    White space inside a block is one space, blocks are joined by one line break. A NULL or
    empty page, and one without words, has an empty text. Every row gives a row; repeated
    rows repeat, NULL ids and urls stay."""
    ship(pages.sparkSession)
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    weights = fit(pages) if weights is None else weights

    def run(batches):
        for batch in in_batches(batches, "html"):
            text = [extract(p, weights) for p in batch.column("html").to_pylist()]
            columns = {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(text, pa.string())}
            yield pa.RecordBatch.from_pydict(columns)

    return pages.mapInArrow(run, "page_id bigint, url string, text string")
