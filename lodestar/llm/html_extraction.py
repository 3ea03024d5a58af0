"""HTML extraction: main text by markup, boilerplate by a suffix array over each host's pages.

A page is cut into blocks.  Blocks in navigation, forms, adverts and the like go
by their markup.  Where a page marks its article, the article's blocks are the
text.  Everything outside an article joins its host's token stream, the streams
of the host's pages being laid end to end.  Suffixes of that stream are sorted;
neighbours that agree for ``run`` tokens form an interval of the array, and an
interval that holds suffixes of two distinct pages is boilerplate.  Pages that
mark no article lose the tokens that such runs cover and keep their unique runs.

A run that covers a token covers it, too, where it is cut to ``run`` tokens, so
the array is sorted to that depth and no deeper.  It is made in parts, a batch
of pages each, whose intervals are merged by host and tokens (the tokens
themselves, not a hash): no host's stream is gathered in one place.

Marked articles are left alone: passages that articles of a host share are
theirs, and cutting them would spoil most articles (see README).
"""

from __future__ import annotations

import html
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import drop_written, hinted, join_counted, materialise, size_of, slim, small_batches

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|iframe|svg|title|select)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_LABEL = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)

# Element names by their part in a page, as HTML defines them.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
_CHROME = set("nav footer aside form head button menu dialog search fieldset".split())
_CHROME_LABELS = set(
    "ad ads adbox advert adverts advertisement advertising adsense banner sponsor sponsored promo promoted promotion "
    "sidebar sidenav nav navbar navigation menu breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices alert "
    "popup modal overlay newsletter subscribe subscription signup comment comments commentlist disqus reply replies respond "
    "share sharing social related recommended widget toolbar pagination pager masthead contentinfo complementary".split()
)
_MARKED = {"article", "main"}


def _is_chrome(name: str, attributes: str, in_article: bool) -> bool:
    if name in _CHROME or (name == "header" and not in_article):
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return name == "article" and _labels(attributes) & {"comment", "comments", "reply"} != set()
    labels = _labels(attributes)
    return bool(labels & _CHROME_LABELS) or ("header" in labels and not in_article)


def _labels(attributes: str) -> set[str]:
    found: set[str] = set()
    for _, value in _LABEL.findall(attributes):
        found.update(re.split(r"[^a-z0-9]+", value.lower()))
    return found


def blocks(page: str) -> list[tuple[str, bool, int, int]]:
    """(text, chrome, article, main) of each block of a page in order; article and main number the element that holds it, 0 for none."""
    found: list[tuple[str, bool, int, int]] = []
    buffer: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # name, whether it is chrome, whether it is a numbered article or main
    chrome = 0
    numbers, inside = {"article": 0, "main": 0}, {"article": [], "main": []}

    def flush() -> None:
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                found.append((text, chrome > 0, *(inside[k][0] if inside[k] else 0 for k in ("article", "main"))))

    def pop() -> None:
        nonlocal chrome
        name, was_chrome, numbered = stack.pop()
        chrome -= was_chrome
        if numbered:
            inside[name].pop()

    def close(names: tuple[str, ...], until: tuple[str, ...]) -> None:
        """End an open element of one of ``names``, unless one of ``until`` stands between."""
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                while len(stack) > i:
                    pop()
                return
            if stack[i][0] in until:
                return

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            buffer.append(html.unescape(page[at : m.start()]))
        at = m.end()
        name = m[3]
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            buffer.append(" ")
        block = name in _BLOCK
        if block:
            flush()
        if m[2]:
            close((name,), ("article", "main", "body") if name not in ("html", "body", "main") else ())
            continue
        if block:
            close(("p",), ("div", "td", "th", "li", "article", "section", "main", "button"))
            if name == "li":
                close(("li",), ("ul", "ol", "menu"))
            elif name in ("td", "th", "tr"):
                close(("td", "th") if name != "tr" else ("tr",), ("table",))
            elif name in ("dd", "dt"):
                close(("dd", "dt"), ("dl",))
            elif name == "body":
                close(("head",), ())
        if name in _VOID or m[4].endswith("/"):
            continue
        is_chrome = _is_chrome(name, m[4], bool(inside["article"]))
        numbered = name in _MARKED
        if numbered:
            numbers[name] += 1
            inside[name].append(numbers[name])
        stack.append((name, is_chrome, numbered))
        chrome += is_chrome
    if at < len(page):
        buffer.append(html.unescape(page[at:]))
    flush()
    return found


def read_page(page: str | None) -> tuple[list[str] | None, list[str]]:
    """(blocks of the marked article or None, the other blocks).

    Without an article, ``main`` stands for it.  Of several, the one with most
    text counts.  Blocks that are chrome by their markup are among the others
    only to show what a host repeats, unless no article is marked.
    """
    found = blocks(page or "")
    for at in (2, 3):
        size: dict[int, int] = {}
        for b in found:
            if b[at] and not b[1]:
                size[b[at]] = size.get(b[at], 0) + len(b[0])
        if size:
            best = max(size, key=lambda k: (size[k], -k))
            return [b[0] for b in found if b[at] == best and not b[1]], [b[0] for b in found if b[at] != best or b[1]]
    return None, [b[0] for b in found if not b[1]]


def host_of(url: str | None) -> str:
    m = re.match(r"(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def intervals(streams: list[tuple[str, list[str]]], run: int) -> list[tuple[str, list[int]]]:
    """The intervals at depth ``run`` of the suffix array over (host, tokens) streams: a run's tokens, and the stream of each suffix.

    Suffixes of different hosts do not meet; those shorter than ``run`` have no part.
    """
    numbers: dict[str, int] = {}
    words = list(chain.from_iterable(tokens for _, tokens in streams))
    flat = np.fromiter((numbers.setdefault(t, len(numbers)) for t in words), np.int64, len(words))
    sizes = np.array([len(tokens) for _, tokens in streams], np.int64)
    ends = np.cumsum(sizes)
    of = np.repeat(np.arange(len(streams)), sizes)
    starts = np.flatnonzero(np.arange(len(flat)) + run <= ends[of]) if len(flat) else np.zeros(0, np.int64)
    if not len(starts):
        return []
    hosts: dict[str, int] = {}
    host = np.array([hosts.setdefault(h, len(hosts)) for h, _ in streams])
    keys = [host[of[starts]], *(flat[starts + i] for i in range(run))]
    order = np.lexsort(keys[::-1])
    # The common prefix with the suffix before reaches the depth where all keys agree.
    agrees = np.all([k[order][1:] == k[order][:-1] for k in keys], axis=0)
    bounds = np.concatenate([[0], np.flatnonzero(~agrees) + 1, [len(order)]]).tolist()
    starts = starts[order]
    return [(" ".join(words[starts[a] : starts[a] + run]), of[starts[a:b]].tolist()) for a, b in zip(bounds, bounds[1:], strict=False)]


def unique_runs(parts: list[str], repeated: set[str], run: int) -> list[str]:
    """The blocks without the tokens that repeated runs cover."""
    tokens = [t for p in parts for t in p.split()]
    gone = np.zeros(len(tokens), bool)
    for i in range(len(tokens) - run + 1 if repeated else 0):
        if " ".join(tokens[i : i + run]) in repeated:
            gone[i : i + run] = True
    kept, at = [], 0
    for p in parts:
        n = len(p.split())
        rest = " ".join(t for t, x in zip(tokens[at : at + n], gone[at : at + n], strict=True) if not x)
        at += n
        if rest:
            kept.append(rest)
    return kept


def main_text(pages: DataFrame, run: int = 6, page_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row (page_id, url, text, n_chars) for each row of ``pages``.

    Character references are decoded, white space inside a block is one space,
    blocks are joined by one newline.  Null or empty pages have the empty text;
    null urls share the host ""; rows equal in all three columns are one page
    among those of their host; an empty table gives no rows.  Other columns are not read.
    """
    small_batches(pages.sparkSession, 500)
    pages = pages.select(
        F.col(page_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    ).withColumn("page_key", F.xxhash64("page_id", "url", "html"))

    def suffixes(batches):
        for batch in batches:
            streams, keys, loose = [], [], []
            for url, page, key in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                article, others = read_page(page)
                streams.append((host_of(url), [t for p in others for t in p.split()]))
                keys.append(key)
                loose.append(article is None)
            rows = []
            for tokens, of in intervals(streams, run):
                host, pages_of = streams[of[0]][0], [keys[i] for i in of]
                rows.append((host, tokens, min(pages_of), max(pages_of), False))
                rows += [(host, tokens, k, k, True) for k in {keys[i] for i in of if loose[i]}]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_()), strict=True)],
                names=["host", "tokens", "low", "high", "loose"],
            )

    stream = materialise(pages.mapInArrow(slim(suffixes), "host string, tokens string, low long, high long, loose boolean"), "page-suffixes")
    found = stream.groupBy(F.struct("host", "tokens").alias("at")).agg(F.min("low").alias("low"), F.max("high").alias("high"), F.count_if("loose").alias("n"))
    repeated = materialise(found.where("low < high and n > 0").select("at", "n"), "page-repeats")
    uncovered = stream.where("loose").select(F.struct("host", "tokens").alias("at"), F.col("low").alias("covered_key"))
    covered = join_counted(uncovered, repeated, "at", "n", uncovered.count()).groupBy("covered_key").agg(F.collect_set("at.tokens").alias("repeated"))
    covered = materialise(covered, "page-covered")
    small = hinted(covered, size_of(covered))
    for df in (stream, repeated):
        drop_written(df)

    def extract(batches):
        for batch in batches:
            texts = []
            for page, found in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                article, others = read_page(page)
                texts.append("\n".join(unique_runs(others, set(found or ()), run) if article is None else article))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return (
        pages.join(small, F.col("page_key") == F.col("covered_key"), "left")
        .select("page_id", "url", "html", "repeated")
        .mapInArrow(slim(extract), "page_id long, url string, text string, n_chars long")
    )
