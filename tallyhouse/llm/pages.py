"""Main text of web pages: block structure, and the difference to the page with the nearest URL."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import append_columns, slices
from tallyhouse.sources.staging import stage

# HTML's elements by what they mean for the text of a page.
RAW = "script|style|noscript|template|textarea|iframe|svg|math|canvas|object|title"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
SKIPPED = frozenset("nav footer aside form button select option datalist menu dialog head".split())
MAIN = frozenset("article main".split())

# Elements that hold prose, and elements that hold anything.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | frozenset("p li dt dd pre blockquote td th caption figcaption address".split())
BARE = frozenset("div section".split())

# Words of a class, id or role that mark what is not the article, words that only go with them, and
# those that mark an article element, or an id inside an article, where the others may well be its topic.
MARK = re.compile(
    r"ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|hidden|masthead|menu|modal|nav|navbar|"
    r"navigation|newsletter|notice|pagination|popup|promo\w*|related|repl(?:y|ies)|shar(?:e|ing)|sidebar|social|sponsor\w*|"
    r"subscribe|teasers?|toolbar|widget"
)
BESIDE = frozenset(
    "area articles bar block bottom box button buttons container form global group header holder icons inner items left "
    "links list main outer page panel policy post posts right section site slot sub top unit user wrap wrapper".split()
)
READERS = re.compile(r"advert\w*|comments?|disqus|promo\w*|related|repl(?:y|ies)|sponsor\w*|teasers?")
ATTRIBUTES = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[^\W\d_a-zA-Z]+")
HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][\w:-]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>",
    re.S | re.I,
)

TABLE_BITS = 1 << 20  # of the table that two runs of lines are compared in at once

# What a line is: left out by its element, open to comparison, in the article, or open to comparison inside the article.
LEFT_OUT, OPEN, ARTICLE, ARTICLE_OPEN = 0, 1, 2, 3


def _marks(value: str, words: re.Pattern) -> bool:
    """Whether one of the names in an attribute consists of the given words and such as only go with them."""
    for name in value.strip("\"'").split():
        parts = [x.lower() for x in PARTS.findall(name)]
        hits = [bool(words.fullmatch(x)) for x in parts]
        if any(hits) and all(hit or x in BESIDE for hit, x in zip(hits, parts)):
            return True
    return False


def _marked(name: str, rest: str, inside: bool) -> bool:
    """Whether an element's class, id or role says that it is not part of the article.

    Names count as a whole: ``related-posts`` does, ``related-work`` does not. Headings never do, and ids of
    prose do not, as they name a topic. Inside an article, and of an article, only reader comments, teasers
    and the like count by id, and an article element needs such a word in its class, too.
    """
    if name in HEADINGS or name in ("html", "body", "main"):
        return False
    for attribute, value in ATTRIBUTES.findall(rest):
        by_id = attribute.lower() == "id"
        if by_id and name in PROSE:
            continue
        if _marks(value, READERS if name == "article" or (by_id and inside) else MARK):
            return True
    return False


def lines_of(page: str) -> list[tuple[str, int]]:
    """The text lines (blocks) of a page in order, each with its kind.

    Inline elements do not end a line; comments, scripts, styles and markup vanish; character references
    are decoded, white space becomes one space. Elements that are left open end with their parent.
    """
    found: list[tuple[str, int]] = []
    stack: list[tuple[str, int]] = []  # open elements, each with the kind of the text in it
    buffer: list[str] = []

    def flush() -> None:
        text = " ".join(entities.unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            found.append((text, stack[-1][1] if stack else OPEN))

    at = 0
    for m in MARKUP.finditer(page):
        if m.start() > at:
            buffer.append(page[at : m.start()])
        at = m.end()
        name = m.group("name")
        if name is None:
            continue
        name = name.lower()
        kind = stack[-1][1] if stack else OPEN
        rest = m.group("rest") or ""
        if name not in INLINE:
            flush()
        elif name == "br":
            buffer.append(" ")
        if m.group("end"):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if any(s[1] != (stack[k - 1][1] if k else OPEN) for s in stack[k:]):
                        flush()
                    del stack[k:]
                    break
            continue
        if name in VOID or rest.endswith("/"):
            continue
        inner = kind
        if kind != LEFT_OUT:
            inside = kind != OPEN
            out = name in SKIPPED or (name == "header" and not inside) or bool(HIDDEN.search(rest))
            if out or _marked(name, rest, inside):
                inner = LEFT_OUT
            elif name in MAIN:
                inner = ARTICLE
            elif inside and name in PROSE:
                inner = ARTICLE
            elif kind == ARTICLE and name in BARE and not any(x in PROSE for x, _ in stack):
                inner = ARTICLE_OPEN
        if inner != kind:
            flush()
        stack.append((name, inner))
    buffer.append(page[at:])
    flush()
    return found


def _rows(a: Sequence[int], b: Sequence[int], keep: bool) -> list[int]:
    """After each item of ``a`` (or after the last one), the places of ``b`` where the common length does not grow.

    Places are bits of one large number, so an item of ``a`` takes a few operations on it, however often it is in ``b``.
    """
    full = (1 << len(b)) - 1
    places: dict[int, int | bytearray] = {x: bytearray(len(b) // 8 + 1) for x in set(a)}
    for j, x in enumerate(b):
        if x in places:
            places[x][j >> 3] |= 1 << (j & 7)
    places = {x: int.from_bytes(v, "little") for x, v in places.items()}
    flat, rows = full, []
    for x in a:
        both = flat & places[x]
        flat = ((flat + both) | (flat - both)) & full
        if keep:
            rows.append(flat)
    return rows if keep else [flat]


def _lengths(a: Sequence[int], b: Sequence[int]) -> np.ndarray:
    """Common length of ``a`` and each beginning of ``b``, the empty one included."""
    flat = _rows(a, b, keep=False)[0]
    bits = np.unpackbits(np.frombuffer(flat.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common_subsequence(a: Sequence[int], b: Sequence[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence of both.

    A common beginning and end belong to one, and what only one side has belongs to none. The rest is
    compared bit by bit: at once where the table of bits is small, else halved where both halves together are longest, so
    memory stays within ``TABLE_BITS`` or a few rows, also for very many equal lines.
    """
    found: list[int] = []
    todo = [(list(enumerate(a)), list(b))]
    while todo:
        left, right = todo.pop()
        values = [x for _, x in left]
        head = _shared_prefix(values, right)
        tail = _shared_prefix(values[head:][::-1], right[head:][::-1])
        found += [i for i, _ in left[:head]] + [i for i, _ in left[len(left) - tail :]]
        left, right = left[head : len(left) - tail], right[head : len(right) - tail]
        common = {x for _, x in left} & set(right)
        left, right = [x for x in left if x[1] in common], [x for x in right if x in common]
        values = [x for _, x in left]
        if not left:
            continue
        if len(left) == 1:
            found.append(left[0][0])
        elif len(left) * len(right) <= TABLE_BITS:
            rows = _rows(values, right, keep=True)
            i, j = len(left), len(right)
            while i and j:
                if rows[i - 1] >> (j - 1) & 1:
                    j -= 1
                    continue
                i -= 1
                if not i or rows[i - 1] >> (j - 1) & 1:
                    j -= 1
                    found.append(left[i][0])
        else:
            half = len(left) // 2
            ends = _lengths(values[:half], right) + _lengths(values[half:][::-1], right[::-1])[::-1]
            cut = int(ends.argmax())
            todo += [(left[:half], right[:cut]), (left[half:], right[cut:])]
    return sorted(found)


def _open_lines(kinds: list[int]) -> list[int]:
    """The lines of a page that it may lose: those open inside its article, or all open ones of a page without one."""
    article = ARTICLE in kinds or ARTICLE_OPEN in kinds
    return [k for k, kind in enumerate(kinds) if kind == (ARTICLE_OPEN if article else OPEN)]


def _summaries(texts: list[str]) -> list:
    lines = [lines_of(t) for t in texts]
    hashes = [[xxhash.xxh64_intdigest(x.encode()) - (1 << 63) for x, _ in page] for page in lines]
    open_ = [_open_lines([kind for _, kind in page]) for page in lines]
    return [pa.array(hashes, pa.list_(pa.int64())), pa.array(open_, pa.list_(pa.int32()))]


def _shared_prefix(a: Sequence, b: Sequence) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _shared_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gone = []
        for r in batch.to_pylist():
            near = [x for x in (r["before"], r["after"]) if x and x["host"] == r["host"]]
            shared: list[int] = []
            if near:
                other = max(near, key=lambda x: _shared_prefix(x["path"], r["path"]))  # the earlier one on a tie
                shared = common_subsequence(r["hashes"], other["hashes"])
            gone.append(sorted(set(shared) & set(r["open"])))
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(gone, pa.list_(pa.int32()))], ["key", "gone"])


def shared_lines(pages: DataFrame) -> DataFrame:
    """``key`` and ``gone``: the open lines that a page shares with its nearest page.

    ``pages`` has ``key``, ``url``, ``html``. Within a host, pages are ordered by path; the nearest page is
    that of the two neighbours whose path has more leading characters in common. Only hashes of lines
    move. Rows are dealt by sampled ranges, so that a host with very many pages is spread, and staged with
    their places; the ends of ranges meet through one row per range.
    """
    fields = [T.StructField("hashes", T.ArrayType(T.LongType())), T.StructField("open", T.ArrayType(T.IntegerType()))]
    narrow = append_columns(pages, "html", fields, _summaries, drop=("html",))
    url = F.coalesce("url", F.lit(""))
    narrow = narrow.select(
        "key", "hashes", "open",
        F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1).alias("path"),
    ).where("host <> ''").dropDuplicates(["key"])
    order = ["host", "path", "key"]
    placed = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(placed.withColumn("place", F.monotonically_increasing_id()), "page-places")
    placed = placed.withColumn("part", F.shiftrightunsigned("place", 33)).withColumn("me", F.struct("host", "path", "hashes"))
    ends = placed.groupBy("part").agg(F.min_by("me", "place").alias("first"), F.max_by("me", "place").alias("last"))
    parts = Window.orderBy("part")
    ends = ends.select("part", F.lag("last").over(parts).alias("left"), F.lead("first").over(parts).alias("right"))
    inside = Window.partitionBy("part").orderBy("place")
    around = placed.select(
        "part", "key", "host", "path", "hashes", "open",
        F.lag("me").over(inside).alias("before"), F.lead("me").over(inside).alias("after"),
    ).where(F.size("open") > 0).join(ends, "part")
    around = around.select(
        "key", "host", "path", "hashes", "open",
        F.coalesce("before", "left").alias("before"), F.coalesce("after", "right").alias("after"),
    )
    return around.mapInArrow(_shared_lines, "key string, gone array<int>").where(F.size("gone") > 0)


def main_text(page: str, gone: set[int]) -> str:
    """Article lines where the page has an article element, else open lines; in both cases less those ``gone``.

    An article that would lose every line is a copy of the other page's and keeps them.
    """
    lines = lines_of(page)
    article = [(k, x) for k, (x, kind) in enumerate(lines) if kind in (ARTICLE, ARTICLE_OPEN)]
    if article:
        return "\n\n".join([x for k, x in article if k not in gone] or [x for _, x in article])
    return "\n\n".join(x for k, (x, kind) in enumerate(lines) if kind == OPEN and k not in gone)


def extract_main_text(df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page.

    Lines of an article or main element are its text: its prose (paragraphs, headings, lists, quotes, tables)
    always, other lines in it (notices, teasers in plain containers) unless the page of the nearest URL on its host
    shares them. A page without an article has its lines outside menus, footers, forms and the like, less those shared.
    Pages are read twice and only move where some page has shared lines, and those are too many for a
    broadcast.

    A missing page is empty and gives the empty text; a missing URL, or one without a host, has no nearest
    page. Rows that repeat come as often as given. Other columns are not read.
    """
    key = F.concat_ws(":", F.coalesce(F.col(f"`{page_id}`").cast("string"), F.lit("-")), F.hex(F.xxhash64(f"`{url}`", f"`{html}`")))
    pages = df.select(
        key.alias("key"), F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html")
    )
    gone = stage(shared_lines(pages.select("key", "url", "html")), "shared-lines")
    schema = T.StructType([df.schema[page_id], df.schema[url]])
    schema = T.StructType(
        [T.StructField("page_id", schema[0].dataType), T.StructField("url", schema[1].dataType),
         T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [
                    main_text(h or "", set(g or ())) for h, g in zip(part.column("html").to_pylist(), part.column("gone").to_pylist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return pages.join(gone, "key", "left").select("page_id", "url", "html", "gone").mapInArrow(extract, schema)
