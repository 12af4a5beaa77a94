"""How the sources of a language differ in the words they use."""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import slices, sums_before
from tallyhouse.llm.transducer import Transducer
from tallyhouse.sources.staging import stage

LEAST_DOCUMENTS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000

ENTRIES = 800_000  # counters are handed on when they hold as many
FILTER_WORDS = 1 << 19  # 64-bit words of the filter of kept terms: 4 MB, however many terms are kept
ROWS = 1 << 16  # rows of two tiles that wait for a comparison
SHARD_TERMS = 4096  # neighbouring terms of one transducer
SALTS = 8  # copies of each transducer, so that often used neighbours are counted by several tasks
TILE = 256  # sources that one block of pairs compares with as many others
BUCKETS = 256  # parts of the terms of a language when pairs are compared
BLOCK = 512  # terms of one dense block

LETTERS = bytes(c for c in range(256) if c >= 0x80 or chr(c).isalpha())
# Bytes that are no part of a term become blanks.
TRANSLATION = bytes(c if c in LETTERS else 0x20 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Runs of letters and of characters outside ASCII, in order; only A to Z are lower-cased."""
    return text.translate(TRANSLATION).lower().split()


def _narrow(df: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    names = {"text": text, "lang": lang, "source": source}
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(n) for n, c in names.items()])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, bytes]]:
    for batch in batches:
        for part in slices(batch, "text"):
            yield from zip(
                part.column("lang").to_pylist(), part.column("source").to_pylist(), part.column("text").cast(pa.binary()).to_pylist()
            )


def document_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``term``, ``documents``: in how many documents of its language a term is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for language, c in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(c), pa.string()), pa.array(list(c), pa.binary()).cast(pa.string()),
                     pa.array(list(c.values()), pa.int64())],
                    ["lang", "term", "documents"],
                )
            counts.clear()

        for language, _, text in _texts(batches):
            counts.setdefault(language, Counter()).update(set(terms_of(text)))
            if sum(map(len, counts.values())) > ENTRIES:
                yield from flush()
        yield from flush()

    each = docs.mapInArrow(run, "lang string, term string, documents long")
    return each.groupBy("lang", "term").agg(F.sum("documents").alias("documents"))


def vocabulary(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang``, ``term``, ``ord``, ``shard``: kept terms with their place in byte order within the language.

    Kept terms are dealt by ranges and sorted; the counts before a range and before a language turn the
    place in a range into the ordinal.
    """
    kept = stage(document_counts(docs).where(F.col("documents") >= least).select("lang", "term"), "kept-terms")
    placed = kept.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    placed = stage(placed.withColumn("place", F.monotonically_increasing_id()), "sorted-terms")
    placed = placed.withColumn("part", F.shiftrightunsigned("place", 33)).withColumn("inside", F.col("place").bitwiseAND((1 << 33) - 1))
    totals = placed.groupBy("part").agg(F.count(F.lit(1)).alias("terms"))
    before = stage(sums_before(totals, "part", "terms").select("part", "before_terms"), "ranges")
    numbered = placed.join(before, "part").withColumn("g", F.col("before_terms") + F.col("inside"))
    numbered = stage(numbered.select("lang", "term", "g"), "numbered-terms")
    first = stage(numbered.groupBy("lang").agg(F.min("g").alias("first")), "languages")
    ord_ = F.col("g") - F.col("first")
    return numbered.join(first, "lang").select(
        "lang", "term", ord_.alias("ord"), F.floor(ord_ / SHARD_TERMS).cast("int").alias("shard")
    )


def kept_filter(kept: DataFrame) -> np.ndarray:
    """Bits of a fixed number: two for each kept term of a language, by its hash.

    What lacks one of its bits is not kept; what has both goes on to the transducer, which decides. With very
    many kept terms most bits are set and more goes on, with the same result.
    """
    h = F.xxhash64("lang", "term")
    places = F.explode(F.array(F.shiftrightunsigned(h, 39), F.shiftrightunsigned(F.shiftleft(h, 25), 39))).alias("at")
    words = kept.select(places).groupBy(F.shiftright("at", 6).alias("word"))
    words = words.agg(F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("bits"))
    bits = np.zeros(FILTER_WORDS, np.uint64)
    for r in words.toLocalIterator():
        bits[r.word] = np.uint64(r.bits & ((1 << 64) - 1))
    return bits


def may_be_kept(bits: np.ndarray, language: str, terms: list[bytes]) -> np.ndarray:
    """For each term, whether the filter has both of its bits."""
    seed = xxhash.xxh64_intdigest(language.encode(), 42)
    h = np.array([xxhash.xxh64_intdigest(t, seed) for t in terms], np.uint64)
    one, two = h >> np.uint64(39), (h << np.uint64(25)) >> np.uint64(39)
    has = [(bits[(x >> np.uint64(6)).astype(np.int64)] >> (x & np.uint64(63))) & np.uint64(1) for x in (one, two)]
    return (has[0] & has[1]).astype(bool)


def recounted(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``ord``, ``count``: occurrences of each kept term in each source.

    The terms of the texts go to the transducer of their range, which is built from the sorted terms that
    come first in its task; what it does not know is dropped. Only the first term of every range (one of
    ``SHARD_TERMS`` kept terms) and a filter of fixed size are known to all tasks: most terms that are not kept
    go no further.
    """
    bits = kept_filter(kept)
    begins: dict[str, list[bytes]] = {}
    for r in kept.where(F.col("ord") % SHARD_TERMS == 0).orderBy("lang", "ord").toLocalIterator():
        begins.setdefault(r.lang, []).append(r.term.encode())
    schema = "lang string, shard int, salt int, ord long, term string, sources array<string>, counts array<long>"
    names = [x.split()[0] for x in schema.split(", ")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = TaskContext.get().partitionId() % SALTS
        counts: dict[tuple[str, str], Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            """One row per language and term, with its count in each source."""
            for language in {g for g, _ in counts}:
                own = [(source, c) for (g, source), c in counts.items() if g == language and c]
                if not own or language not in begins:
                    continue
                coded = pa.array([t for _, c in own for t in c], pa.binary()).dictionary_encode()
                likely = may_be_kept(bits, language, coded.dictionary.to_pylist())
                chosen = likely[coded.indices.to_numpy()]
                if not chosen.any():
                    continue
                terms = coded.dictionary.filter(pa.array(likely))
                code = (np.cumsum(likely) - 1)[coded.indices.to_numpy()[chosen]]
                order = np.argsort(code, kind="stable")
                offsets = pa.array(np.append(0, np.cumsum(np.bincount(code, minlength=len(terms)))).astype(np.int32))
                place = np.repeat(np.arange(len(own)), [len(c) for _, c in own])[chosen][order]
                values = np.array([v for _, c in own for v in c.values()], np.int64)[chosen][order]
                sources = pa.array([source for source, _ in own], pa.string()).take(pa.array(place))
                starts = begins[language]
                shards = np.array([bisect_right(starts, t) - 1 for t in terms.to_pylist()], np.int32)
                n = len(terms)
                made = pa.RecordBatch.from_arrays(
                    [pa.array([language] * n, pa.string()), pa.array(shards), pa.array(np.full(n, salt, np.int32)),
                     pa.array(np.full(n, -1)), terms.cast(pa.string()), pa.ListArray.from_arrays(offsets, sources),
                     pa.ListArray.from_arrays(offsets, pa.array(values))],
                    names,
                )
                yield made.filter(pa.array(shards >= 0))
            counts.clear()

        size = 0
        for language, source, text in _texts(batches):
            c = counts.setdefault((language, source), Counter())
            size -= len(c)
            c.update(terms_of(text))
            size += len(c)
            if size > ENTRIES:
                yield from flush()
                size = 0
        yield from flush()

    words = docs.mapInArrow(count, schema)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("sources", "array<string>"), ("counts", "array<bigint>"))]
    terms = kept.select("lang", "shard", salts, "ord", "term", *none)
    key = ["lang", "shard", "salt"]
    # Terms of a range come before what is counted in it: those have no ordinal yet.
    rows = terms.union(words).repartition(*key).sortWithinPartitions(*key, F.col("ord") < 0, "ord")
    out = ["lang", "ord", "sources", "counts"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, base, built, waiting = None, 0, None, []

        for batch in batches:
            each = list(zip(*[batch.column(c).to_pylist() for c in key]))
            edges = [k for k in range(len(each)) if k == 0 or each[k] != each[k - 1]] + [len(each)]
            for a, b in zip(edges, edges[1:]):
                if each[a] != known:
                    known, base, built, waiting = each[a], each[a][1] * SHARD_TERMS, None, []
                part = batch.slice(a, b - a)
                ordinals = part.column("ord").to_numpy()
                n = int((ordinals >= 0).sum())
                waiting.extend(part.column("term").slice(0, n).cast(pa.binary()).to_pylist())
                if n == b - a:
                    continue
                if built is None:
                    built, waiting = Transducer(waiting), []
                part = part.slice(n)
                found = built.ordinals(part.column("term").cast(pa.binary()))
                hit = pa.array(found >= 0)
                columns = [part.column("lang"), pa.array(found + base), part.column("sources"), part.column("counts")]
                yield pa.RecordBatch.from_arrays([c.filter(hit) for c in columns], out)

    hits = rows.mapInArrow(walk, "lang string, ord long, sources array<string>, counts array<long>")
    hits = hits.select("lang", "ord", F.inline(F.arrays_zip("sources", "counts")))
    return hits.groupBy("lang", F.col("sources").alias("source"), "ord").agg(F.sum("counts").alias("count"))


def share(count: Column, n: Column, v: Column) -> Column:
    """Smoothed share of a term in billionths, in exact whole numbers; ``n`` words over ``v`` terms."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    bottom = (n + 2 * v).cast("decimal(20,0)")
    return F.call_function("div", top, bottom) + 1


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def groups_of(docs: DataFrame, kept: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per language and source, also of those without terms: place ``src`` among the sources of the
    language, words ``n``, terms ``v``, words of the language ``all_n``, and the share ``z`` of a term it lacks."""
    groups = docs.select("lang", "source").distinct()
    n = counts.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    v = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    found = groups.join(n, ["lang", "source"], "left").join(v, "lang", "left").fillna(0, ["n", "v"])
    all_n = found.groupBy("lang").agg(F.sum("n").alias("all_n"))
    found = found.join(all_n, "lang")
    z = F.when(F.col("v") > 0, share(F.lit(0).cast("long"), F.col("n"), F.col("v"))).otherwise(1)
    src = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    return found.withColumn("z", z).withColumn("src", src)


class _TilePair:
    """Sums of gaps between the sources of two tiles, over the terms that some source of the two has."""

    def __init__(self, key: list, tile: int):
        self.key, self.tile, self.header, self.ready, self.terms = key, tile, [], False, 0
        self.rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def _start(self) -> None:
        self.header.sort()
        self.ids = np.array([s for s, _ in self.header], np.int64)
        self.missing = np.array([z for _, z in self.header], np.int64)
        self.left = np.flatnonzero(self.ids // self.tile == self.key[1])
        self.right = np.flatnonzero(self.ids // self.tile == self.key[2])
        self.sums = np.zeros((len(self.left), len(self.right)), np.int64)
        self.ready = True

    def add(self, ords, src, p) -> None:
        """Rows of terms, in order of the terms."""
        if not self.ready:
            self._start()
        self.rows.append(tuple(np.atleast_1d(x) for x in (ords, src, p)))
        self.waiting += len(self.rows[-1][0])
        if self.waiting >= ROWS:
            self._compare(last=False)

    def _compare(self, last: bool) -> None:
        """Dense blocks of terms and sources, with the share of a missing term where a source lacks it.

        The last term stays unless it is known to be complete.
        """
        if not self.rows:
            return
        ords, src, p = (np.concatenate(x) for x in zip(*self.rows))
        full = len(ords) if last else int(np.searchsorted(ords, ords[-1]))
        self.rows, self.waiting = [(ords[full:], src[full:], p[full:])], len(ords) - full
        term = np.cumsum(np.append(False, ords[1:full] != ords[: full - 1])) if full else ords[:0]
        place = np.searchsorted(self.ids, src[:full])
        for k in range(0, int(term[-1]) + 1 if full else 0, BLOCK):
            a, b = np.searchsorted(term, [k, k + BLOCK])
            grid = np.repeat(self.missing[None, :], term[b - 1] - k + 1, 0)
            grid[term[a:b] - k, place[a:b]] = p[a:b]
            for m, x in enumerate(self.left):
                d = grid[:, x : x + 1] - grid[:, self.right]
                self.sums[m] += (d * d // (grid[:, x : x + 1] + grid[:, self.right])).sum(0)
            self.terms += len(grid)

    def result(self) -> pa.RecordBatch:
        if not self.ready:
            self._start()
        self._compare(last=True)
        a, b = np.repeat(self.ids[self.left], len(self.right)), np.tile(self.ids[self.right], len(self.left))
        sums, other = self.sums.ravel(), a != b
        a, b, sums = a[other], b[other], sums[other]
        if self.key[1] != self.key[2]:
            a, b, sums = np.append(a, b), np.append(b, a), np.append(sums, sums)
        columns = [pa.array([self.key[0]] * len(a), pa.string()), pa.array(a), pa.array(b), pa.array(sums),
                   pa.array(np.full(len(a), self.terms))]
        return pa.RecordBatch.from_arrays(columns, ["lang", "a", "b", "part", "terms"])


def pair_values(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item``, ``value`` for every two sources of a language, both ways.

    Sources are tiled and terms dealt into buckets; a task holds the sums of two tiles and one block of
    terms. Terms that no source of the two tiles has are counted, not visited: all have the same gap.
    """
    tile = F.floor(F.col("src") / TILE).cast("int")
    tiles = groups.groupBy("lang").agg(F.max(tile).alias("last"))
    spread = F.explode(F.sequence(F.lit(0), F.col("last"))).alias("u")

    def dealt(df: DataFrame) -> DataFrame:
        df = df.join(tiles, "lang").select("*", spread).withColumn("t", tile)
        return df.select("lang", F.least("t", "u").alias("i"), F.greatest("t", "u").alias("j"), "bucket", "ord", "src", "p")

    buckets = F.explode(F.sequence(F.lit(0), F.lit(BUCKETS - 1))).alias("bucket")
    header = groups.select("lang", "src", F.col("z").alias("p"), F.lit(-1).cast("long").alias("ord"), buckets)
    rows = shares.select("lang", "src", "p", "ord", F.pmod(F.xxhash64("ord"), F.lit(BUCKETS)).cast("int").alias("bucket"))
    key = ["lang", "i", "j", "bucket"]
    dealt_rows = dealt(header).union(dealt(rows)).repartition(*key).sortWithinPartitions(*key, "ord")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _TilePair | None = None
        for batch in batches:
            each = list(zip(*[batch.column(c).to_pylist() for c in key]))
            edges = [k for k in range(len(each)) if k == 0 or each[k] != each[k - 1]] + [len(each)]
            ords, src, p = (batch.column(c).to_numpy() for c in ("ord", "src", "p"))
            for a, b in zip(edges, edges[1:]):
                if now is None or now.key != list(each[a]):
                    if now is not None:
                        yield now.result()
                    now = _TilePair(list(each[a]), TILE)
                first = a + int((ords[a:b] < 0).sum())
                now.header.extend(zip(src[a:first].tolist(), p[a:first].tolist()))
                if first < b:
                    now.add(ords[first:b], src[first:b], p[first:b])
        if now is not None:
            yield now.result()

    parts = dealt_rows.mapInArrow(run, "lang string, a long, b long, part long, terms long")
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("part").alias("part"), F.sum("terms").alias("terms"))
    one = groups.select("lang", F.col("src").cast("long").alias("a"), "source", "v", F.col("z").alias("za"))
    two = groups.select("lang", F.col("src").cast("long").alias("b"), F.col("source").alias("item"), F.col("z").alias("zb"))
    rest = (F.col("v") - F.col("terms")) * gap(F.col("za"), F.col("zb"))
    return sums.join(one, ["lang", "a"]).join(two, ["lang", "b"]).select(
        "lang", "source", "item", F.when(F.col("v") > 0, F.col("part") + rest).otherwise(0).alias("value")
    )


def source_divergence(
    df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS
) -> DataFrame:
    """How far every two sources of a language are apart (part ``pair``), and by which terms a source
    stands out of its language most (part ``term``): ``lang, source, part, item, value, rank``.

    Missing texts, languages and sources are empty. Sources without terms are compared as well, with
    counts of zero; where a language keeps no term, all its values are 0. Repeated rows count as often
    as they come. An empty table gives an empty result. Other columns are not read.
    """
    docs = _narrow(df, text, lang, source)
    kept = stage(vocabulary(docs, least), "vocabulary")
    counts = stage(recounted(docs, kept), "source-counts")
    groups = stage(groups_of(docs, kept, counts), "sources")
    shares = counts.join(groups, ["lang", "source"]).withColumn("p", share(F.col("count"), F.col("n"), F.col("v")))
    shares = stage(shares.select("lang", "source", "src", "ord", "p", "all_n", "v"), "shares")

    pairs = pair_values(shares, groups).withColumn("part", F.lit("pair"))
    over = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(over))

    common = stage(counts.groupBy("lang", "ord").agg(F.sum("count").alias("all_count")), "language-counts")
    terms = shares.join(common, ["lang", "ord"]).withColumn("q", share(F.col("all_count"), F.col("all_n"), F.col("v")))
    terms = terms.where("p > q").withColumn("value", gap(F.col("p"), F.col("q")))
    # Ordinals are in byte order of the terms, so that ties need no terms yet.
    over = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ord")
    best = terms.withColumn("rank", F.row_number().over(over)).where(F.col("rank") <= top)
    best = best.join(kept.select("lang", "ord", F.col("term").alias("item")), ["lang", "ord"]).withColumn("part", F.lit("term"))

    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).union(best.select(*columns))
