"""Collocations: phrases whose words go together, from stripes of next words.

A stripe belongs to a prefix word of a language and counts what follows it: nothing more (the word by
itself), one word, or two words. Stripes of equal keys are added elementwise, and one merged stripe holds
the total of its prefix, all extensions of it, and for each phrase of two words the most frequent
extension to its right.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import slices, text_of
from tallyhouse.sources.staging import stage

LEAST = 10  # occurrences of a candidate
SUBSUMED_PERCENT = 50
TOP = 2000
SCALE = 1_000_000
UNKNOWN_LANGUAGE = "und"

FLUSH_BYTES = 16 << 20  # of text that one set of stripes covers
SHARDS = 8  # parts of a stripe, by the word that follows, so that no frequent word has one large stripe
MERGE_BYTES = 4 << 20

# Piece ends become a byte that no text holds; a tab separates words as a space does.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
END = b"\xff"
TRANSLATION = bytes.maketrans(PIECE_ENDS + b"\t", END * len(PIECE_ENDS) + b" ")

STRIPES = "lang string, prefix string, shard int, next string, counts array<int>"
PHRASES = "lang string, phrase string, words int, f long, inside long"


def _parts(text: bytes) -> Iterator[bytes]:
    """A text in parts of about the flush size, cut at piece ends only."""
    text = text.lower().translate(TRANSLATION)
    begin = 0
    while len(text) - begin > FLUSH_BYTES:
        cut = text.find(END, begin + FLUSH_BYTES)
        if cut < 0:
            break
        yield text[begin:cut]
        begin = cut
    yield text[begin:] if begin else text


def _counted(texts: list[bytes]) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array] | None:
    """Stripes of translated texts: prefix, shard, next words (joined by line ends) and their counts."""
    tokens = END.join(texts).replace(END, b" \xff ").split()
    coded = pa.array(tokens, pa.binary()).dictionary_encode()
    del tokens
    words, ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    names = words.to_pylist()
    n = len(names)
    end = names.index(END) if END in names else n
    inner = ids != end
    if not inner.any():
        return None
    single = np.bincount(ids, minlength=n)
    single[end : end + 1] = 0
    at = np.flatnonzero(inner[:-1] & inner[1:])
    pairs, which, pair_counts = np.unique(ids[at] * n + ids[at + 1], return_inverse=True, return_counts=True)
    follows = np.flatnonzero(at[1:] == at[:-1] + 1)
    threes, three_counts = np.unique(which[follows] * n + ids[at[follows] + 2], return_counts=True)

    shard = np.array([zlib.crc32(w) % SHARDS for w in names], np.int64)
    first = np.flatnonzero(single)
    second, third = pairs[threes // n], threes % n
    key = np.concatenate([
        first * SHARDS, pairs // n * SHARDS + shard[pairs % n], second // n * SHARDS + shard[second % n],
    ])
    following = pa.concat_arrays([
        pa.array([b""] * len(first), pa.binary()), words.take(pa.array(pairs % n)),
        pc.binary_join_element_wise(words.take(pa.array(second % n)), words.take(pa.array(third)), b" "),
    ])
    counts = np.concatenate([single[first], pair_counts, three_counts]).astype(np.int32)
    order = np.argsort(key, kind="stable")
    keys, begins = np.unique(key[order], return_index=True)
    offsets = pa.array(np.append(begins, len(order)).astype(np.int32))
    joined = pc.binary_join(pa.ListArray.from_arrays(offsets, following.take(pa.array(order))), b"\n")
    return (
        words.take(pa.array(keys // SHARDS)), pa.array((keys % SHARDS).astype(np.int32)), joined,
        pa.ListArray.from_arrays(offsets, pa.array(counts[order])),
    )


def stripes(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Stripes of every few megabytes of text, combined within them; one language to a stripe."""
    names = [x.split()[0] for x in STRIPES.split(", ")]
    source = df.select(
        F.coalesce(F.col(f"`{lang}`"), F.lit(UNKNOWN_LANGUAGE)).alias("lang"), text_of(f"`{text}`").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[bytes]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for language in list(waiting):
                made = _counted(waiting.pop(language))
                if made is None:
                    continue
                prefix, shard, following, counts = made
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(shard), pa.string()), prefix.cast(pa.string()), shard,
                     following.cast(pa.string()), counts],
                    names,
                )

        for batch in batches:
            for piece in slices(batch, "text"):
                for language, raw in zip(piece.column("lang").to_pylist(), piece.column("text").cast(pa.binary()).to_pylist()):
                    for part in _parts(raw):
                        waiting.setdefault(language, []).append(part)
                        size += len(part)
                        if size >= FLUSH_BYTES:
                            yield from flush()
                            size = 0
        yield from flush()

    return source.mapInArrow(run, STRIPES)


def _added(keys: np.ndarray, following: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Entries of equal key and next words added up, in order of the keys."""
    table = pa.table({"k": keys, "next": following, "c": counts}).group_by(["k", "next"]).aggregate([("c", "sum")])
    table = table.combine_chunks()
    k = table["k"].to_numpy()
    order = np.argsort(k, kind="stable")
    following = table["next"].combine_chunks().take(pa.array(order))
    return k[order], following, table["c_sum"].to_numpy()[order]


class _Open:
    """The stripe that the last rows belong to; it is added up again only when it has doubled."""

    def __init__(self, key: tuple):
        self.key, self.parts, self.size, self.base = key, [], 0, 0

    def add(self, following: pa.Array, counts: np.ndarray) -> None:
        self.parts.append((following, counts))
        self.size += len(counts)
        if self.size > 2 * self.base + (1 << 18):
            self.close()

    def close(self) -> tuple[pa.Array, np.ndarray]:
        following = pa.concat_arrays([p[0] for p in self.parts])
        counts = np.concatenate([p[1] for p in self.parts])
        if len(self.parts) > 1:
            _, following, counts = _added(np.zeros(len(counts), np.int64), following, counts)
        self.parts, self.size, self.base = [(following, counts)], len(counts), len(counts)
        return following, counts


def _described(langs: list, prefixes: list, keys: np.ndarray, following: pa.Array, counts: np.ndarray, least: int):
    """Rows of merged stripes; ``keys`` are places in ``langs`` and ``prefixes``."""
    blank = pc.equal(following, "").to_numpy(zero_copy_only=False)
    totals: dict[str, int] = {}
    for k, c in zip(keys[blank].tolist(), counts[blank].tolist()):
        totals[langs[k]] = totals.get(langs[k], 0) + c
    often = np.flatnonzero(counts >= least)
    rows, best = [], {}
    for k, phrase, c in zip(keys[often].tolist(), following.take(pa.array(often)).to_pylist(), counts[often].tolist()):
        second, _, third = phrase.partition(" ")
        if third:
            best[k, second] = max(c, best.get((k, second), 0))
        rows.append((k, phrase, 3 if third else 2 if second else 1, c))
    out = [(langs[k], f"{prefixes[k]} {p}" if p else prefixes[k], n, c, best.get((k, p), 0) if n == 2 else 0) for k, p, n, c in rows]
    return [*out, *[(g, "", 0, c, 0) for g, c in totals.items()]]


def merged(made: DataFrame, least: int = LEAST) -> DataFrame:
    """Phrases of one to three words with ``least`` occurrences or more, from stripes added elementwise.

    ``f`` is the number of occurrences, ``inside`` that of the most frequent extension of a phrase of two
    words to the right. A row without words has the word occurrences of some stripes of its language.
    A task takes the stripes in order and holds one slice of them and one unfinished stripe.
    """
    names = [x.split()[0] for x in PHRASES.split(", ")]
    key = ["lang", "prefix", "shard"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: _Open | None = None

        def rows(*described) -> Iterator[pa.RecordBatch]:
            found = _described(*described, least)
            if found:
                kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)], names)

        def finish() -> Iterator[pa.RecordBatch]:
            if last is not None:
                following, counts = last.close()
                yield from rows([last.key[0]], [last.key[1]], np.zeros(len(counts), np.int64), following, counts)

        for batch in batches:
            for piece in slices(batch, "next", MERGE_BYTES):
                each = list(zip(*[piece.column(c).to_pylist() for c in key]))
                starts = [k for k in range(len(each)) if k == 0 or each[k] != each[k - 1]]
                run_of_row = np.zeros(len(each), np.int64)
                run_of_row[starts[1:]] = 1
                run_of_row = np.cumsum(run_of_row)
                split = pc.split_pattern(piece.column("next"), "\n")
                keys = run_of_row[pc.list_parent_indices(split).to_numpy()]
                counts = pc.list_flatten(piece.column("counts")).to_numpy().astype(np.int64)
                keys, following, counts = _added(keys, pc.list_flatten(split), counts)
                n = len(starts)
                edges = np.searchsorted(keys, np.arange(n + 1))
                a = 0
                if last is not None and last.key == each[0]:
                    last.add(following[: edges[1]], counts[: edges[1]])
                    if n == 1:
                        continue
                    a = 1
                yield from finish()
                last = None
                b = n - 1
                if b > a:
                    inner = slice(edges[a], edges[b])
                    heads = [each[s] for s in starts]
                    yield from rows([h[0] for h in heads], [h[1] for h in heads], keys[inner], following[inner], counts[inner])
                if b >= a:
                    last = _Open(each[starts[b]])
                    last.add(following[edges[b] :], counts[edges[b] :])
        yield from finish()

    return made.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, PHRASES)


def collocations(
    df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, subsumed: int = SUBSUMED_PERCENT, top: int = TOP
) -> DataFrame:
    """The ``top`` phrases of two and three words of each language: ``lang, rank, phrase, a, l, r, n, score``.

    The score of a phrase is that of its weakest cut in two, ``a * a / (l * r)`` in millionths. Phrases with
    at least ``subsumed`` percent of their occurrences inside one longer candidate are left out.

    Missing texts are empty, a missing language is ``und``, a language without candidates has no rows.
    Repeated rows count as often as they come. An empty table gives an empty result. Other columns are
    not read. Texts are cut at piece ends where they are long; a piece stays whole.
    """
    found = stage(merged(stripes(df, text, lang), least), "phrases")
    sizes = found.where("words = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    phrases = found.where("words > 0")
    # The most frequent extension to the left, from the phrases of three words by their last two.
    left = phrases.where("words = 3").groupBy("lang", F.substring_index("phrase", " ", -2).alias("phrase"))
    left = left.agg(F.max("f").alias("before"))
    inside = F.greatest("inside", F.coalesce("before", F.lit(0)))
    kept = phrases.where("words > 1").join(left, ["lang", "phrase"], "left").where(100 * inside < subsumed * F.col("f"))

    w = F.split("phrase", " ")
    cuts = F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice(w, F.lit(1), k), " ").alias("first"),
        F.array_join(F.slice(w, k + 1, F.size(w) - k), " ").alias("rest"),
    ))
    cut = kept.select("lang", "phrase", F.col("f").alias("a"), F.inline(cuts))
    of = phrases.select("lang", "phrase", "f")
    cut = cut.join(of.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cut = cut.join(of.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    wide = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "l", "r")}
    exact = (wide["a"] * wide["a"] * F.lit(SCALE)).cast("decimal(38,0)")
    cut = cut.withColumn("top", exact).withColumn("bottom", wide["l"] * wide["r"]).withColumn("score", F.expr("top div bottom"))
    scored = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    scored = scored.select("lang", "phrase", "a", "m.l", "m.r", "m.score")

    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First within parts of a language, so that no task orders more than the best of each part.
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*best)
    likely = scored.withColumn("place", F.row_number().over(part)).where(F.col("place") <= top).drop("place")
    ranked = likely.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    return ranked.where(F.col("rank") <= top).join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
