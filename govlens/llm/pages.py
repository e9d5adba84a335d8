"""Main text of web pages as the maximum-scoring subsequence of their tokens.

A page is a sequence of words and tags.  Words score above zero and tags
below, with weights learned from pages that mark their own content; one
linear scan finds the contiguous region of the highest sum.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govlens.llm.common import bounded_batches, held, released, table

# Names of HTML.
#: Elements whose content is not markup.
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "xmp", "noembed", "noframes")
#: Elements that hold no article text, wherever they stand.
ASIDE = ("nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "fieldset", "object", "canvas", "audio", "video")
#: Elements that don't end a block.
INLINE = ("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
          "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "wbr")
#: Other elements with weights of their own; unknown names share one.
BLOCK = ("article", "main", "section", "div", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "table",
         "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "blockquote", "pre", "figure", "figcaption", "header", "hr",
         "address", "details", "summary", "center", "body", "html", "head", "meta", "link", "base")
VOID = ("br", "img", "hr", "meta", "link", "input", "base", "wbr", "col", "area", "embed", "source", "track", "param")
#: Elements that a new one of their kind ends.
SELF_ENDING = ("p", "li", "dt", "dd", "tr", "td", "th", "option")
#: Elements that part running text without setting it off.
FLOWING = (*INLINE, "p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "hr")
#: Elements that mark the content, on pages that have them: what the weights are learned from.
#: In scoring, their beginning is one more token with a learned weight.
MARKS = ("article", "main")
#: Words in class, id or role that tell boilerplate.
BOILERPLATE = frozenset("""ad ads adv advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments
 consent contentinfo cookie cookies dialog disqus footer gdpr login masthead menu menus modal nav navbar navigation newsletter notice
 notices paywall popup popups promo promos promotion related search share sharing sidebar sidebars signup skip social sponsor
 sponsored sponsors subscribe subscription toolbar topbar widget widgets""".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)"
    r"|(?P<text>[^<]+|<)", re.S)
TAG_STOP = re.compile(r"[\"'>]")
ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
NAME_PART = re.compile(r"[a-z]+")
KNOWN = frozenset(RAW + ASIDE + INLINE + BLOCK)

#: What a word weighs where nothing was learned, and how many words outweigh a tag that was never seen.
WORD_WEIGHT, TAG_WEIGHT = 1.0, -1.0
#: Weights stay within these: words above zero, tags below; a word outweighs the tags of a paragraph around it.
LEAST, LEAST_WORD, MOST = 0.05, 0.2, 8.0


def _boilerplate(rest: str) -> bool:
    if not rest:
        return False
    if HIDDEN.search(rest):
        return True
    return any(p in BOILERPLATE for _, *v in ATTRIBUTE.findall(rest) for p in NAME_PART.findall("".join(v).lower()))


def _tag_end(page: str, pos: int, unpaired: set[str]) -> tuple[int, int]:
    """Where a tag's attributes end, and where it does: at the first ``>`` outside quotes.

    A quote that nothing closes is a character like any other; ``unpaired``
    remembers the kinds that no longer occur, so that each is looked for in
    vain once in a page.
    """
    while m := TAG_STOP.search(page, pos):
        pos = m.end()
        if m[0] == ">":
            return m.start(), pos
        if m[0] not in unpaired:
            close = page.find(m[0], pos)
            if close < 0:
                unpaired.add(m[0])
            else:
                pos = close + 1
    return len(page), len(page)


def tokens(page: str) -> Iterator[tuple[str, str, bool, bool, int]]:
    """(kind, value, marked, aside, block) in order: kind is "word" or a tag's name, value a text run.

    marked: inside an element that marks content; aside: inside one that holds
    none; block: the number of the block that a run of text belongs to.
    """
    open_: list[tuple[str, bool, bool]] = []             # name, marks, aside
    where: dict[str, list[int]] = defaultdict(list)        # places of each name in open_
    solid: list[int] = [-1]                                # places of elements that aren't inline
    unpaired: set[str] = set()
    marked = aside = block = pos = 0

    def close_last() -> None:
        nonlocal marked, aside
        name, marks, off = open_.pop()
        where[name].pop()
        if solid[-1] == len(open_):
            solid.pop()
        marked -= marks
        aside -= off

    while m := TOKEN.match(page, pos):
        pos = m.end()
        text = m["text"]
        if text is not None:
            yield "word", text, marked > 0, aside > 0, block
            continue
        name = m["name"]
        if name is None:                                   # a comment or a declaration
            continue
        stop, end = _tag_end(page, pos, unpaired)
        rest, pos = page[pos:stop], end
        name = name.lower()
        inline = name in INLINE
        block += not inline
        kind = name if name in KNOWN else "other"
        if m["end"]:
            was = aside > 0
            # what was left open inside an element ends with it, but an inline element ends no block
            if where[name] and (not inline or where[name][-1] > solid[-1]):
                for _ in range(len(open_) - where[name][-1]):
                    close_last()
            yield "/" + kind, "", marked > 0, was, block
            continue
        if name in RAW:
            yield kind, "", marked > 0, aside > 0, block
            close = re.compile(rf"</{name}\s*>", re.I).search(page, pos)
            pos = close.end() if close else len(page)
            continue
        if name in SELF_ENDING:
            while open_ and (open_[-1][0] == name or open_[-1][0] in INLINE):
                close_last()
        off = name in ASIDE or (name == "header" and not marked) or (name not in ("html", "body", *MARKS) and _boilerplate(rest))
        yield kind, "", marked > 0, aside > 0 or off, block
        if name not in VOID and not rest.endswith("/"):
            where[name].append(len(open_))
            if not inline:
                solid.append(len(open_))
            open_.append((name, name in MARKS, off))
            marked += name in MARKS
            aside += off


def page_counts(page: str) -> tuple[Counter, Counter]:
    """Tokens inside and outside the marked content of a page; two empty counters if it marks none."""
    inside, outside = Counter(), Counter()
    for kind, text, marked, aside, _ in tokens(page):
        if kind == "word":
            (inside if marked and not aside else outside)[kind] += len(text.split())
        elif not aside:
            (inside if marked or kind in MARKS else outside)[kind] += 1
    return (inside, outside) if inside["word"] else (Counter(), Counter())


def learn_weights(pages: DataFrame, payload_col: str = "html") -> dict[str, float]:
    """Weights from all pages that mark their content: the log odds of a token inside it, words and marks above zero, other tags below.

    What is gathered has one row per kind of token, of which there are fewer than 300.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = (Counter(), Counter())
        for b in batches:
            for page in b["page"]:
                for total, one in zip(held, page_counts(page), strict=True):
                    total.update(one)
        rows = [(k, held[0][k], held[1][k]) for k in held[0] | held[1]]
        yield pd.DataFrame(rows, columns=["kind", "inside", "outside"])

    bounded_batches(pages.sparkSession)
    found = pages.select(F.col(payload_col).alias("page")).where("page is not null") \
        .mapInPandas(run, "kind string, inside long, outside long") \
        .groupBy("kind").agg(F.sum("inside").alias("i"), F.sum("outside").alias("o")).collect()
    total_in, total_out = sum(r["i"] for r in found), sum(r["o"] for r in found)
    out = {}
    for r in found:
        odds = math.log((r["i"] + 1) / (total_in + 1)) - math.log((r["o"] + 1) / (total_out + 1))
        if r["kind"] in ("word", *MARKS):
            out[r["kind"]] = min(max(odds, LEAST_WORD if r["kind"] == "word" else LEAST), MOST)
        else:
            out[r["kind"]] = max(min(odds, -LEAST), -MOST)
    return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """The first contiguous range of the highest positive sum, and of those the longest; (0, 0) if there is none."""
    best, low, high, total, start = 0.0, 0, 0, 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best or (total == best and start == low and total > 0):
            best, low, high = total, start, i + 1
    return low, high


def extract(page: str | None, weights: dict[str, float]) -> str:
    """The main text of one page: blocks in page order, joined by line feeds."""
    if not page:
        return ""
    held = list(tokens(page))
    word, scores = weights.get("word", WORD_WEIGHT), []
    for kind, text, _, aside, _ in held:
        if kind == "word":
            # menus, adverts and the like are never content: an article goes on behind them
            scores.append(0.0 if aside else word * len(text.split()))
        elif aside or kind in RAW:
            scores.append(-LEAST)                          # a script, say, may stand anywhere in a text
        else:
            scores.append(weights.get(kind, LEAST if kind in MARKS else -LEAST if kind.lstrip("/") in FLOWING else TAG_WEIGHT * word))
    low, high = best_region(scores)
    if low == high:
        return ""
    # whole blocks: a region that touches a block has it all
    inside = {b for kind, t, _, aside, b in held[low:high] if kind == "word" and not aside and t.strip()}
    blocks: dict[int, list[str]] = {}
    for kind, text, _, aside, b in held:
        if b in inside and not aside:
            blocks.setdefault(b, []).append(" " if kind.lstrip("/") == "br" else text)
    lines = (" ".join(html.unescape("".join(x)).split()) for x in blocks.values())
    return "\n".join(x for x in lines if x)


def extract_text(pages: DataFrame, weights: dict[str, float], payload_col: str = "html") -> DataFrame:
    """``pages`` plus ``_text``: the whole main text of each page.

    A null or empty page, and one without a word outside menus, adverts and
    the like, gives an empty text.  An ``article`` or ``main`` element is a
    token with a learned weight above zero and decides nothing by itself.  Of
    regions that tie, the first is taken.  Time is linear in the page's length.
    Character references are decoded after the markup is gone; white space in
    a block is one space.  Repeated rows get the same text; an empty table
    gives an empty table.
    """
    @F.pandas_udf(T.StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([extract(p, weights) for p in s.where(s.notna(), None)], index=s.index, dtype=object)
    bounded_batches(pages.sparkSession)
    src = held(pages, _page=payload_col)
    return src.select(*released(pages.columns, _text=run("_page")))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    out = extract_text(pages.select("page_id", "url", "html"), learn_weights(pages))
    return out.select("page_id", "url", F.col("_text").alias("text"), F.char_length("_text").cast("long").alias("n_chars"))
