"""Main text of web pages: declared structure, and what the pages of a host repeat.

Markup says much: menus, adverts, forms and the like are named by their elements or classes,
and an ``article`` (or ``main``) element holds the text. Text that markup says nothing about
is judged by repetition: stretches of ``RUN_WORDS`` words that stand on ``LEAST_PAGES``
distinct pages of a host are boilerplate; what is left of a block are its unique runs. Text
inside a declared article is kept even where other pages have it too, as articles quote and
mirror each other, and does not count as a repeat elsewhere.

Every page of a host counts, however many there are, and the same number of pages makes a
repeat on every host. Runs are counted as 64-bit numbers made of the host and the words, first
in every map task and then over all, so a host is never brought together in one task. Only
runs that are repeats go back, to the pages that have them.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygate.llm.common import cut, small
from tallygate.llm.url_filters import host_of

#: Pages of a map task whose runs are added up before Spark is given them.
GROUP_PAGES = 256
#: A stretch of this many words on this many pages of a host is boilerplate.
RUN_WORDS, LEAST_PAGES = 8, 3

# --- Fixed values: what elements and class names mean --------------------------
DROPPED = frozenset(
    "head title script style noscript template nav header footer aside form button select"
    " textarea iframe svg canvas object dialog menu".split()
)
DROPPED_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside"
    " notice notices cookie cookies consent banner popup modal ad ads advert adverts"
    " advertisement sponsor sponsored promo form login signup search newsletter subscribe"
    " comment comments commentlist replies disqus contentinfo complementary".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist replies".split())
KEPT_NAMES = frozenset("article post entry content story main".split())
ARTICLE = frozenset(("article", "main"))
BLOCKS = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu"
    " nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
INLINE_ENDS = frozenset("p li dt dd td th tr option".split())  # may lack an end tag
IMPLIED_ENDS = {  # the start of an element ends those before it
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "tr": ("td", "th", "tr"),
    "option": ("option",),
}
RAW = "script|style|textarea|title|noscript|iframe|template"

# Attributes end at the next tag's beginning, and what was matched is not tried anew, so that
# tags that never end cost no more than others.
ATTRS = r"""(?:"[^"]*"|'[^']*'|[^<>"'])*+"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{RAW})\b{ATTRS}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>{ATTRS})>"
    r"|<[!?/][^<>]*+>"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL | re.IGNORECASE,
)
#: Numbers of characters that no character has; the library takes no number that long.
_LONG_NUMBER = re.compile(r"&#([0-9]{8,})")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z0-9]+")

CORE, OPEN, CHROME = 0, 1, 2


def _named_away(attrs: str, dropped: frozenset[str] = DROPPED_NAMES) -> bool:
    """Whether a class, id or role says that an element is not the article's."""
    for match in _NAMES.finditer(attrs):
        for name in (match[1] or match[2] or match[3] or "").lower().split():
            words = set(_WORD.findall(name))
            if words & dropped and not words & KEPT_NAMES:
                return True
    return False


class _Open:
    """The elements that are open, and where among them those of a name and the blocks are."""

    def __init__(self) -> None:
        self.elements: list[tuple[str, bool, bool]] = []  # name, in dropped, in article
        self.places: dict[str, list[int]] = {}
        self.block_places: list[int] = [-1]

    def state(self) -> tuple[bool, bool]:
        return self.elements[-1][1:] if self.elements else (False, False)

    def push(self, name: str, dropped: bool, inside: bool) -> None:
        self.places.setdefault(name, []).append(len(self.elements))
        if name in BLOCKS:
            self.block_places.append(len(self.elements))
        self.elements.append((name, dropped, inside))

    def cut(self, at: int) -> None:
        """Close the element at a place and all in it."""
        while len(self.elements) > at:
            name = self.elements.pop()[0]
            self.places[name].pop()
            if name in BLOCKS:
                self.block_places.pop()

    def close_implied(self, name: str) -> None:
        """Close what the start of a block ends: a paragraph, and an item of its own kind."""
        ended = {"p", *IMPLIED_ENDS.get(name, ())}
        while (at := self.block_places[-1]) >= 0 and self.elements[at][0] in ended:
            self.cut(at)

    def close(self, name: str) -> None:
        """What an end tag closes. That of a paragraph or of inline mark-up does not close the
        block it stands in."""
        places = self.places.get(name)
        weak = name not in BLOCKS or name in INLINE_ENDS
        if places and not (weak and self.block_places[-1] > places[-1]):
            self.cut(places[-1])


def _characters(text: str) -> str:
    """Text with its character references decoded."""
    if "&#" in text:
        text = _LONG_NUMBER.sub(lambda m: "&#" + (m[1].lstrip("0") or "0")[:8], text)
    return html.unescape(text)


def blocks(page: str) -> list[tuple[int, str]]:
    """(kind, text) of a page's blocks in order, white space made single spaces, none empty.

    Headers are dropped, also those of articles with a headline in them. An article that is
    named as a reader's comment goes, and one within another by any name that drops others.
    """
    out: list[tuple[int, str]] = []
    pending: list[str] = []
    stack = _Open()
    dropped = inside = False

    def flush() -> None:
        text = " ".join(_characters("".join(pending)).split())
        pending.clear()
        if text:
            out.append((CHROME if dropped else CORE if inside else OPEN, text))

    for token in _TOKEN.finditer(page):
        text = token["text"]
        if text is not None:
            pending.append(text)
            continue
        if token["name"] is None:
            continue  # comments, declarations, elements without text of the page
        name = token["name"].lower()
        if name in BLOCKS:
            flush()
        elif name == "br":
            pending.append(" ")
        if name in VOID:
            continue
        if not token["end"]:
            if name in BLOCKS:
                stack.close_implied(name)
                dropped, inside = stack.state()
            if name in ARTICLE:
                away = _named_away(token["attrs"], DROPPED_NAMES if inside else COMMENT_NAMES)
            else:
                away = name in DROPPED or (
                    name not in ("body", "html") and _named_away(token["attrs"])
                )
            article = name in ARTICLE and not away
            if away and not dropped or article and not inside:
                flush()
            dropped, inside = dropped or away, inside or article
            stack.push(name, dropped, inside)
        else:
            before = (dropped, inside)
            stack_size = len(stack.elements)
            stack.close(name)
            if len(stack.elements) < stack_size:
                after = stack.state()
                if before != after:
                    flush()
                dropped, inside = after
    flush()
    return out


# --- Repetition -------------------------------------------------------------------


def sorted_suffix_classes(stream: np.ndarray, depth: int) -> np.ndarray:
    """For each place of ``stream``, a number that places with the same next ``depth`` items share.

    The suffix array's ranks, by doubling, to the depth that is asked for. Places whose next
    items run over the end have classes of their own kind.
    """
    rank = np.unique(stream, return_inverse=True)[1].astype(np.int64)
    have = 1
    while have < depth:
        step = min(have, depth - have)
        later = np.full(len(rank), -1, np.int64)
        later[: len(rank) - step] = rank[step:]
        pairs = rank * (len(rank) + 1) + later + 1
        rank = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        have += step
    return rank


def repeated(streams: list[list[str]], least_pages: int) -> list[np.ndarray]:
    """For each page's words, which of them lie in stretches found on ``least_pages`` pages."""
    numbers: dict[str, int] = {}
    parts, pages = [], []
    for page, words in enumerate(streams):
        parts.append([numbers.setdefault(w, len(numbers)) for w in words] + [-page - 1])
        pages.append(np.full(len(words) + 1, page))
    stream, page_of = np.concatenate([np.array(p, np.int64) for p in parts]), np.concatenate(pages)
    marked = np.zeros(len(stream) + RUN_WORDS + 1, np.int64)
    if len(streams) >= least_pages and len(stream) > RUN_WORDS:
        classes = sorted_suffix_classes(stream, RUN_WORDS)
        # Each page's end is an item of its own, so a stretch across it occurs once.
        seen = np.unique(np.stack([classes, page_of]), axis=1)[0]
        on_pages = np.bincount(seen, minlength=classes.max() + 1)
        starts = np.flatnonzero(on_pages[classes] >= least_pages)
        np.add.at(marked, starts, 1)
        np.add.at(marked, starts + RUN_WORDS, -1)
    covered = np.cumsum(marked)[: len(stream)] > 0
    ends = np.cumsum([len(p) for p in parts])
    return [covered[e - len(p) : e - 1] for e, p in zip(ends, parts)]


def outside(page: list[tuple[int, str]]) -> list[str]:
    """The words that may be boilerplate, or show what is: all but those of articles."""
    return [w for kind, text in page if kind != CORE for w in text.split(" ")]


def main_text(page: list[tuple[int, str]], covered: np.ndarray) -> str:
    """The text of a page of which ``covered`` says for all words outside articles if they are
    repeated. Structure has the last word: an article stays whole, and is all there is."""
    if any(kind == CORE for kind, _ in page):
        return " ".join(text for kind, text in page if kind == CORE)
    kept, at = [], 0
    for kind, text in page:
        words = text.split(" ")
        if kind == OPEN:
            left = [w for w, c in zip(words, covered[at : at + len(words)]) if not c]
            if left:
                kept.append(" ".join(left))
        at += len(words)
    return " ".join(kept)


def group_texts(pages: list[list[tuple[int, str]]]) -> list[str]:
    """The main texts of all pages of one host, from their blocks, with a suffix array.

    What ``extracted`` finds without having the host's pages in one place.
    """
    covered = repeated([outside(page) for page in pages], LEAST_PAGES)
    return [main_text(page, marks) for page, marks in zip(pages, covered)]


# --- Repetition over a whole host ------------------------------------------------------

#: Odd multipliers of the places of a run; any will do.
_PLACES = np.array(
    [pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(RUN_WORDS)], np.uint64
)
_KNOWN_WORDS = 1_000_000


class Runs:
    """The runs of one page after another, as numbers."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}

    def _number(self, word: str) -> int:
        """Of a word, or of a host after a line end, which no word has."""
        number = self.numbers.get(word)
        if number is None:
            if len(self.numbers) >= _KNOWN_WORDS:
                self.numbers.clear()
            digest = hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8)
            number = self.numbers[word] = int.from_bytes(digest.digest(), "little")
        return number

    def of(self, host: str, words: list[str]) -> np.ndarray:
        """A number for each place at which ``RUN_WORDS`` words begin."""
        count = len(words) - RUN_WORDS + 1
        if count <= 0:
            return np.empty(0, np.int64)
        numbers = np.array([self._number(w) for w in words], np.uint64)
        runs = np.full(count, self._number("\n" + host), np.uint64)
        for place, factor in enumerate(_PLACES):
            runs += numbers[place : place + count] * factor
            runs ^= runs >> np.uint64(32)
        return runs.view(np.int64)


def covered_by(runs: np.ndarray, known: np.ndarray, words: int) -> np.ndarray:
    """Which of a page's words lie in a run that is one of ``known``."""
    marked = np.zeros(words + RUN_WORDS + 1, np.int64)
    starts = np.flatnonzero(np.isin(runs, known))
    np.add.at(marked, starts, 1)
    np.add.at(marked, starts + RUN_WORDS, -1)
    return np.cumsum(marked)[:words] > 0


# --- In Spark -----------------------------------------------------------------------


def extracted(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    articles: bool = True,
) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``.

    Null and empty pages have an empty text. Pages without a host (or a null URL) are
    taken as one host's. Rows repeated whole are pages of their own; an empty table gives
    an empty result. Without ``articles`` an ``article`` is a block as any other, so that
    repetition decides on its text too.

    Pages are read and parsed three times: to count runs, to find the pages with repeats,
    and for their text. Their text moves only if repeats are too many to be broadcast.
    """
    kind = pages.schema[id_column].dataType.simpleString()
    rows = pages.select(
        F.col(id_column).alias("page_id"),
        F.col(url_column).alias("url"),
        F.coalesce(host_of(F.col(url_column)), F.lit("")).alias("host"),
        F.coalesce(F.col(html_column), F.lit("")).alias("html"),
    ).withColumn("key", F.md5(F.concat_ws("\n", "host", "html").cast("binary")))

    def parsed(page: str) -> list[tuple[int, str]]:
        found = blocks(page)
        return found if articles else [(OPEN if k == CORE else k, t) for k, t in found]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, held = Runs(), []
        for rows in batches:
            for host, page in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                held.append(np.unique(runs.of(host, outside(parsed(page)))))
                if len(held) >= GROUP_PAGES:
                    yield summed(held)
                    held = []
        if held:
            yield summed(held)

    def summed(held: list[np.ndarray]) -> pa.RecordBatch:
        found, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int64()), pa.array(n, pa.int64())], ["run", "n"]
        )

    # A page is one row of one task, so counts of tasks add up to distinct pages.
    known = cut(
        rows.select("host", "html")
        .mapInArrow(count, "run bigint, n bigint")
        .groupBy("run")
        .agg(F.sum("n").alias("pages"))
        .where(F.col("pages") >= LEAST_PAGES)
        .select("run")
    )

    def undeclared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs()
        for rows in batches:
            for key, host, page in zip(*(column.to_pylist() for column in rows.columns)):
                page = parsed(page)
                if OPEN in (kinds := {k for k, _ in page}) and CORE not in kinds:
                    own = np.unique(runs.of(host, outside(page)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key] * len(own), pa.string()), pa.array(own, pa.int64())],
                        ["key", "run"],
                    )

    # Pages of the same host and markup have the same repeats. Articles have no use for any.
    repeats = cut(
        rows.select("key", "host", "html")
        .mapInArrow(undeclared, "key string, run bigint")
        .join(small(known, known.count()), "run")
        .groupBy("key")
        .agg(F.collect_set("run").alias("known"))
    )
    size = repeats.agg(F.coalesce(F.sum(F.size("known")), F.lit(0))).first()[0]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs()
        for rows in batches:
            texts = []
            for host, page, known in zip(*(rows.column(c).to_pylist() for c in (2, 3, 4))):
                page = parsed(page)
                words = outside(page)
                covered = np.zeros(len(words), bool)
                if known:
                    own = runs.of(host, words)
                    covered = covered_by(own, np.array(known, np.int64), len(words))
                texts.append(main_text(page, covered))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    rows.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    return (
        rows.join(small(repeats, size), "key", "left")
        .select("page_id", "url", "host", "html", "known")
        .mapInArrow(finish, f"page_id {kind}, url string, text string, n_chars bigint")
    )


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))
