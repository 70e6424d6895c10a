"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block element, where what stands in menus, headers, footers, sidebars, notices,
adverts, forms, comments, scripts and styles leaves an empty line. Over the lines, text lengths are summed in sliding windows. The text surges where
a window's sum rises over a threshold and dives where it falls to nothing; all lines between are kept, short ones too, and so are
the headings and paragraphs next to them that a dropped container cuts off, and what follows it in the same wrapper. The threshold is taken from the page itself, so a page with one short paragraph keeps it. The windows decide on every page;
article and main are a cue: only if they hold the strongest window and most of the text, lines outside count as stripped.

Defined cases: null or empty html, or a page without text, gives an empty text. A container that is never closed ends at the next block. Names (class, id, role)
of inline elements, and of elements that hold an article, main, h1 or most of the page's text, drop nothing; nor does what follows has, with or no in a name, nor a
form or dialog around such a part. A slash at the end of a block's tag says nothing, as in HTML. Pages of any length are read whole. Of windows of equal
text the first counts. Repeated rows are treated alike; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

WINDOW = 3
#: A surge needs this share of the page's largest window, and at most this many characters.
SURGE_SHARE = 0.1
SURGE_CHARS = 80

#: Elements of HTML by their role here.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
CONTAINERS = frozenset(
    "nav footer aside form menu dialog head button select textarea iframe object svg canvas noscript template audio video map".split()
)
#: Containers that may as well be wrapped around a whole page.
WRAPPING = frozenset("form dialog".split())
#: Characters of a form without article, main or h1 from which on it may be the page.
WRAPPED_CHARS = 140
#: Wrappers around a line that are told apart; what is nested deeper counts as one.
MAX_DEPTH = 64
RAW = ("script", "style", "textarea", "title", "xmp", "noembed", "noframes")
#: Elements whose short lines belong to the main text beside them.
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre".split())
LISTED = frozenset("li dt dd td th caption option".split())
WRAPPERS = frozenset("article body center dd details dialog div fieldset form main section td".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
NAMES = (
    "ad ads adbox adsbygoogle adslot adunit advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies crumbs disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination "
    "popup promo promotion recommended related replies share sharing sidebar signup social sponsor sponsored subscribe toolbar topbar widget widgets"
)
#: Words beside "header" in a name that make it the head of the article, not of the page.
ARTICLE_NAMES = frozenset("article content entry post story title".split())
#: Words after which a name tells of something else on the page, or not there.
MODIFIERS = frozenset("has have with without no not".split())
#: Words of names whose elements hold replies, teasers or notices even where these are marked as articles or are long.
ASIDE_NAMES = frozenset("comment comments consent cookie cookies disqus gdpr recommended related replies".split())
_NAMED = frozenset(NAMES.split())
_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog form".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b[^>]*>.*?(?:</(?P=raw)\s*>|$)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_HUMP = re.compile(r"([a-z])([A-Z])")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)


def _name_words(value: str) -> set[str]:
    """Words of a class or id; of each name only those before a modifier."""
    found = set()
    for name in value.strip("\"'").split():
        for word in re.split(r"[^a-z]+", _HUMP.sub(r"\1 \2", name).lower()):
            if word in MODIFIERS:
                break
            found.add(word)
    return found


def _is_noise(name: str, rest: str, inside_article: bool, holds_main: Callable[..., bool]) -> bool:
    """Whether an element is dropped. Names count for block elements that do not hold the main part of the page, as ``holds_main`` tells."""
    if name in WRAPPING:
        return not holds_main(False, WRAPPED_CHARS)
    if name in CONTAINERS or (name == "header" and not inside_article):
        return True
    if not rest or name in ("body", "html", "article", "main"):
        return False
    named = set()
    for attribute, value in _ATTRIBUTE.findall(rest):
        if attribute.lower() == "role":
            if _ROLES.intersection(re.split(r"[^a-z]+", value.lower())) and not (name in BLOCKS and holds_main(False)):
                return True
        else:
            words = _name_words(value)
            if _NAMED.intersection(words) or ("header" in words and not inside_article and not ARTICLE_NAMES.intersection(words)):
                named |= words
    return bool(named) and name in BLOCKS and not holds_main(bool(ASIDE_NAMES.intersection(named)))


def _closes_itself(token: re.Match) -> bool:
    """A slash before the end of a tag closes it only where HTML has no element of that name."""
    return token["rest"].endswith("/") and token["name"].lower() not in BLOCKS | CONTAINERS


class _Elements:
    """Where the elements of a page end, and what they hold."""

    def __init__(self, tokens: list[re.Match]):
        self.last: dict[int, int] = {}  # place of the closing tag by the place of the opening one
        open_tags: dict[str, list[int]] = {}
        for i, token in enumerate(tokens):
            name = token["name"]
            if name is not None and not _closes_itself(token):
                stack = open_tags.setdefault(name.lower(), [])
                if not token["close"]:
                    stack.append(i)
                elif stack:
                    self.last[stack.pop()] = i
        self.unclosed = {i for stack in open_tags.values() for i in stack}
        # Running sums over the tokens outside containers: characters, tags that open the main part, and h1 within article or main.
        chars, marks, heads, until, article_until = [0], [0], [0], -1, -1
        for i, token in enumerate(tokens):
            name = (token["name"] or "").lower()
            if name in CONTAINERS - WRAPPING and not token["close"]:
                until = max(until, self.last.get(i, -1))
            if name in ("article", "main") and not token["close"]:
                article_until = max(article_until, self.last.get(i, len(tokens)))
            counts = i > until
            chars.append(chars[-1] + (len(token["text"].strip()) if counts and token["text"] else 0))
            marks.append(marks[-1] + (counts and not token["close"] and name in ("article", "main", "h1")))
            heads.append(heads[-1] + (counts and not token["close"] and name == "h1" and i < article_until))
        self.chars, self.marks, self.heads = chars, marks, heads

    def holds_main(self, i: int, aside: bool, least: int = 0) -> bool:
        """An article, main or h1, or most of the text of a page that has no article with an h1, of ``least`` characters or more; of an element
        that is ``aside`` by its name only if none of them is elsewhere."""
        if i not in self.last:
            return False
        end = self.last[i]
        marks, chars = self.marks[end] - self.marks[i], self.chars[end] - self.chars[i]
        if aside and self.marks[-1] > marks:
            return False
        return marks > 0 or (not self.heads[-1] and chars >= least and 2 * chars > self.chars[-1])


def text_lines(html: str) -> tuple[list[str], list[int], list[bool], list[tuple[int, ...]], list[bool]]:
    """The page's lines, one per block, the number of the article or main element that each stands in (0 outside; inner ones have the number of the
    outer), whether it is a heading or paragraph, the wrappers around it from the outermost on, and whether it is of a list or table;
    stretches of other matter and the borders of such elements become empty lines."""
    lines: list[str] = []
    inside: list[int] = []
    prose: list[bool] = []
    wrapped: list[tuple[int, ...]] = []
    listed: list[bool] = []
    around: list[tuple[str, int]] = []  # open wrappers
    block = ""  # the block element that opened last and is still open
    parts: list[str] = []
    noise, depth, articles, number = "", 0, 0, 0
    tokens = list(_TOKEN.finditer(html))
    elements = _Elements(tokens)
    until_block = False  # the container at work is never closed

    def end_line(empty: bool = False) -> None:
        line = " ".join(unescape("".join(parts)).split())
        parts.clear()
        if line or empty:
            lines.append(line)
            inside.append(number if articles else 0)
            prose.append(block in PROSE)
            wrapped.append(tuple(n for _, n in around))
            listed.append(block in LISTED)
        if empty and line:
            lines.append("")
            inside.append(0)
            prose.append(False)
            wrapped.append(())
            listed.append(False)

    deeper = 0  # wrappers that are open beyond the number looked at

    def wrap(name: str, closing: bool, place: int) -> None:
        nonlocal deeper
        if deeper or not closing and len(around) == MAX_DEPTH:
            deeper += -1 if closing else 1
        elif not closing:
            around.append((name, place))
        elif any(name == n for n, _ in around):
            while around.pop()[0] != name:
                pass

    for i, token in enumerate(tokens):
        text = token["text"]
        if text is not None:
            if not noise:
                parts.append(text)
            continue
        name = token["name"]
        if name is None:
            if token["raw"] and not noise and token["raw"].lower() in ("title", "textarea"):
                end_line(True)
            continue
        name, closing = name.lower(), bool(token["close"])
        if noise:
            if name == noise and not (until_block and not closing):
                depth += -1 if closing else 0 if _closes_itself(token) else 1
            elif until_block and name in BLOCKS:
                depth = 0
            elif name == "body" and noise == "head":
                depth = 0
            if depth > 0:
                continue
            noise = ""
            if closing or name not in BLOCKS:
                continue
        if name in ("article", "main"):
            end_line(True)
            number += not closing and not articles
            articles = max(0, articles + (-1 if closing else 1))
        if not closing and name not in VOID and _is_noise(name, token["rest"], articles > 0, partial(elements.holds_main, i)):
            end_line(True)
            noise, depth = name, 0 if _closes_itself(token) else 1
            until_block = i in elements.unclosed
            if not depth:
                noise = ""
            if name in BLOCKS:
                block = ""
        elif name in BLOCKS:
            end_line()
            block = "" if closing else name
            if name in WRAPPERS:
                wrap(name, closing, i)
        elif name == "br":
            parts.append(" ")
    end_line()
    return lines, inside, prose, wrapped, listed


def window_sums(lengths: np.ndarray) -> np.ndarray:
    """Text of the ``WINDOW`` lines from each line on, as far as no empty line ends it."""
    total, going = np.zeros_like(lengths), np.ones(len(lengths), bool)
    for k in range(min(WINDOW, len(lengths))):
        following = np.concatenate((lengths[k:], np.zeros(k, np.int64)))
        going &= following > 0
        total += np.where(going, following, 0)
    return total


def main_span(lengths: np.ndarray) -> tuple[int, int]:
    """First and last line, exclusive, of the main text: from the first surge to the last dive, where the text falls to nothing."""
    if not lengths.any():
        return 0, 0
    threshold = min(SURGE_CHARS, SURGE_SHARE * window_sums(lengths).max())
    first = int(np.flatnonzero(window_sums(lengths) > threshold)[0])
    dive = len(lengths) - 1 - np.flatnonzero(window_sums(lengths[::-1]) > threshold)[0]
    # A surge and a dive reach as far as the lines go on without an empty one.
    gaps = np.flatnonzero(np.concatenate(([True], lengths == 0, [True]))) - 1
    return int(gaps[gaps < first][-1]) + 1, int(gaps[gaps > dive][0])


def marks_main(lengths: np.ndarray, inside: np.ndarray) -> bool:
    """Whether the page's articles are its main part: the strongest window and most of the text stand in them."""
    return bool(inside[window_sums(lengths).argmax()]) and 2 * lengths[inside > 0].sum() > lengths.sum()


def _common(chains: list[tuple[int, ...]]) -> tuple[int, ...]:
    """The wrappers that all lines stand in."""
    low, high = min(chains), max(chains)
    return next((low[:k] for k, (a, b) in enumerate(zip(low, high)) if a != b), low[: len(high)])


def with_neighbours(
    lengths: np.ndarray, inside: np.ndarray, prose: np.ndarray, first: int, last: int, wrapped: list[tuple[int, ...]], listed: list[bool]
) -> tuple[int, int]:
    """The span and the blocks before and after it that a dropped container may have cut off, however short: those of the article that the
    span begins or ends in, and outside of articles headings and paragraphs, up to the first other block. What follows the span in its own wrapper
    stays, lists and tables also where no wrapper is around the span."""
    own = _common([wrapped[line] for line in range(first, last) if lengths[line]])

    def joins(line: int, edge: int) -> bool:
        return not lengths[line] or inside[line] == inside[edge] and bool(inside[edge] or prose[line])

    def follows(line: int) -> bool:
        return inside[line] == inside[last - 1] and (wrapped[line][: len(own)] == own if own else listed[line])

    begin, end = first, last
    while begin > 0 and joins(begin - 1, first):
        begin -= 1
    while end < len(lengths) and (joins(end, last - 1) or follows(end)):
        end += 1
    return begin, end


def main_text(html: str | None) -> str:
    lines, numbers, marked, wrapped, listed = text_lines(html or "")
    lengths, inside, prose = np.array([len(line) for line in lines], np.int64), np.array(numbers, np.int64), np.array(marked, bool)
    if not lengths.any():
        return ""
    if marks_main(lengths, inside):
        lengths = np.where(inside > 0, lengths, 0)  # other lines count as stripped
    first, last = with_neighbours(lengths, inside, prose, *main_span(lengths), wrapped, listed)
    return "\n".join(line for line, n in zip(lines[first:last], lengths[first:last]) if n)


def extract(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """``keep`` columns and the ``text`` of every whole page."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(h) for h in part.column(len(keep)).to_pylist()]
                kept = [part.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], names=[*keep, "text"])

    narrow = pages.select(*[F.col(c) for c in keep], F.col(html).cast("string").alias("_html"))
    return narrow.mapInArrow(run, T.StructType([*[pages.schema[c] for c in keep], T.StructField("text", T.StringType())]))
