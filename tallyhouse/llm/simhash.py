"""Near duplicates by 64-bit fingerprints, compared exactly in tiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import append_columns, text_of
from tallyhouse.llm.components import connected_components
from tallyhouse.sources.staging import stage

SEED = 42  # of the shingle hash: a fixed value
SHINGLE_WORDS = 3
RADIUS = 3
PARTS = RADIUS + 1  # two fingerprints within the radius have one of so many equal parts
PART_BITS = 64 // PARTS

SHINGLES_AT_ONCE = 1 << 16
TILE = 512  # rows of a tile
ROWS = 4096  # of neighbouring cells that are tiled together
PIECES = 1 << 16  # pieces that the fingerprints of one part and count may be cut into
CELL = 1 << 15  # fingerprints that one task compares with one another at most


def fingerprint(text: str) -> int:
    """A bit is one if more than half of the shingle hashes have it; zero for a text without words."""
    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[min(SHINGLE_WORDS, len(words)) - 1 :].tolist()
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for a in range(0, n, SHINGLES_AT_ONCE):
        spans = zip(starts[a : a + SHINGLES_AT_ONCE], stops[a : a + SHINGLES_AT_ONCE])
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(df: DataFrame, text: str = "text", name: str = "fp") -> DataFrame:
    """Add the fingerprint of each text as a signed whole number; missing texts are empty."""

    def compute(texts: list[str]) -> list:
        return [pa.array(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))]

    return append_columns(df, text, [T.StructField(name, T.LongType())], compute, drop=(text,))


def _part(values: np.ndarray, k: int) -> np.ndarray:
    return (values >> np.uint64(k * PART_BITS)) & np.uint64((1 << PART_BITS) - 1)


class Forest:
    """Union of positions; keeps only links that join two trees."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def roots(self, x: np.ndarray) -> np.ndarray:
        r = self.parent[x]
        while not np.array_equal(self.parent[r], r):
            r = self.parent[r]
        self.parent[x] = r
        return r

    def _root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        apart = self.roots(a) != self.roots(b)
        for x, y in zip(a[apart].tolist(), b[apart].tolist()):
            rx, ry = self._root(x), self._root(y)
            if rx != ry:
                self.parent[max(rx, ry)] = min(rx, ry)
                self.links.append((x, y))


def tile_pairs(counts: np.ndarray) -> Iterator[tuple[int, int]]:
    """First rows of all pairs of tiles that are compared, by the sorted population counts of their rows.

    A pair is skipped when its counts differ by more than the radius.
    """
    for a in range(0, len(counts), TILE):
        top = counts[min(a + TILE, len(counts)) - 1]
        for b in range(a, len(counts), TILE):
            if counts[b] - top > RADIUS:
                break
            yield a, b


def tile_links(values: np.ndarray, sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A forest that links all positions whose fingerprints are within the radius of one another.

    The fingerprints are put in order of their population count and cut into tiles; a pair of tiles is
    compared whole, by exclusive-or and bit count. With ``sides``, only positions of different sides are compared.
    """
    counts = np.bitwise_count(values).astype(np.int64)
    order = np.argsort(counts, kind="stable")
    v = values[order]
    s = None if sides is None else sides[order]
    forest = Forest(len(v))
    for a, b in tile_pairs(counts[order]):
        near = np.bitwise_count(v[a : a + TILE, None] ^ v[None, b : b + TILE]) <= RADIUS
        if s is not None:
            near &= s[a : a + TILE, None] != s[None, b : b + TILE]
        i, j = np.nonzero(near)
        if a == b:
            i, j = i[i < j], j[i < j]
        if len(i):
            first = np.full(near.shape[1], -1)
            first[j[::-1]] = i[::-1]  # the first row near each column
            columns = np.unique(j)
            forest.add(a + first[columns], b + columns)
            ties = np.unique(i.astype(np.int64) * TILE + first[j])
            forest.add(a + ties // TILE, a + ties % TILE)
    return [(int(order[x]), int(order[y])) for x, y in forest.links]


LINKS_SCHEMA = "a long, b long"
LINKS_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _cell_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside the cells of a sorted range.

    Neighbouring cells are tiled together, about ``ROWS`` rows at once: a fingerprint near one of another cell is
    as good a link. A cell with two sides is tiled alone.
    """
    left: list[np.ndarray] = []

    def links(cell: np.ndarray, fp: np.ndarray, side: np.ndarray) -> pa.RecordBatch:
        starts = np.concatenate([[0], np.flatnonzero(np.diff(cell)) + 1])
        group = np.where(side[starts] == 0, starts // ROWS, -1 - np.arange(len(starts)))
        bounds = [*starts[np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1])].tolist(), len(cell)]
        a, b = [], []
        for begin, end in zip(bounds, bounds[1:]):
            part = slice(begin, end)
            found = tile_links(fp[part], None if side[begin] == 0 else side[part])
            if found:
                x, y = np.array(found).T
                a.append(fp[part][x])
                b.append(fp[part][y])
        empty = np.zeros(0, np.uint64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([*z, empty]).view(np.int64)) for z in (a, b)], schema=LINKS_ARROW
        )

    for batch in batches:
        now = [
            batch.column("cell").to_numpy(),
            batch.column("fp").to_numpy().view(np.uint64),
            batch.column("side").to_numpy(),
        ]
        now = [np.concatenate(x) for x in zip(left, now)] if left else now
        end = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0  # the last cell may go on
        if end:
            yield links(*[x[:end] for x in now])
        left = [x[end:] for x in now]
    if left and len(left[0]):
        yield links(*left)


def fingerprint_links(distinct: DataFrame, fp: str = "fp") -> DataFrame:
    """Links (``a``, ``b``) that join all distinct fingerprints within the radius of one another.

    Of fingerprints that differ in at most ``RADIUS`` bits, one of ``PARTS`` equal parts is the same, so it is
    enough that those that share a part meet in a pair of tiles: a cell. A cell of up to ``CELL`` fingerprints is compared in
    one task. A larger one is cut by population count and a digest into pieces of about that size, and
    every pair of pieces whose counts are within the radius is a cell of its own, so that no shared
    value makes one large task and no pair is lost. The links of a cell are a forest, not all its pairs.
    """
    parts = distinct.select(F.col(fp).alias("fp")).select(
        "fp",
        F.expr("bit_count(fp)").cast("int").alias("ones"),
        F.explode(F.array(*[F.struct(
            (F.shiftrightunsigned("fp", k * PART_BITS).bitwiseAND((1 << PART_BITS) - 1) + F.lit(k << PART_BITS)).alias("part")
        ) for k in range(PARTS)])).alias("x"),
    ).select("fp", "ones", F.col("x.part").alias("part"))
    parts = parts.withColumn("part", F.col("part").cast("long"))
    by_count = parts.groupBy("part", "ones").agg(F.count(F.lit(1)).alias("n"))
    large = by_count.groupBy("part").agg(F.sum("n").alias("total")).where(F.col("total") > CELL).select("part")
    pieces = by_count.join(large, "part").select(
        "part", "ones", F.ceil(F.col("n") / F.lit(CELL // 2)).cast("int").alias("n_pieces")
    )
    plain = parts.join(large, "part", "left_anti").select(
        F.col("part").alias("cell"), "fp", F.lit(0).alias("side")
    )
    names = pieces.select("part", "ones", F.explode(F.expr("sequence(0, n_pieces - 1)")).alias("piece"))
    other = names.select("part", F.col("ones").alias("ones_b"), F.col("piece").alias("piece_b"))
    pairs = names.join(other, "part").where(
        ((F.col("ones_b") > F.col("ones")) & (F.col("ones_b") - F.col("ones") <= RADIUS))
        | ((F.col("ones_b") == F.col("ones")) & (F.col("piece_b") >= F.col("piece")))
    )
    # A negative number names the cell of a pair of pieces; a cell of one piece compares all of it.
    number = F.col("part") * 128 + F.col("ones")
    number = number * (RADIUS + 1) + F.col("ones_b") - F.col("ones")
    number = (number * PIECES + F.col("piece")) * PIECES + F.col("piece_b")
    pairs = pairs.select(
        "part", "ones", "piece", "ones_b", "piece_b", (-number - 1).alias("cell"),
        ((F.col("ones") == F.col("ones_b")) & (F.col("piece") == F.col("piece_b"))).alias("alone"),
    )
    ends = pairs.select(
        "part", "cell",
        F.explode(F.when(F.col("alone"), F.array(F.struct("ones", "piece", F.lit(0).alias("side")))).otherwise(
            F.array(
                F.struct("ones", "piece", F.lit(1).alias("side")),
                F.struct(F.col("ones_b").alias("ones"), F.col("piece_b").alias("piece"), F.lit(2).alias("side")),
            )
        )).alias("e"),
    ).select("part", "cell", "e.*")
    hot = (
        parts.join(pieces, ["part", "ones"])
        .withColumn("piece", F.expr("cast(pmod(xxhash64(fp), n_pieces) as int)"))
        .join(ends, ["part", "ones", "piece"])
        .select("cell", "fp", "side")
    )
    cells = plain.unionByName(hot).repartition("cell").sortWithinPartitions("cell", F.expr("bit_count(fp)"))
    return cells.mapInArrow(_cell_links, LINKS_SCHEMA)


def _grouped(df: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Every row's ``doc_id``, ``digest`` (of the text) and ``fp``, and each ``fp`` with the ``first`` row of its component.

    The first row is the one with the smallest id, missing ones last, then with the smallest digest.
    """
    narrow = df.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(text_of(f"`{text}`")).alias("digest"),
        F.col(f"`{text}`").alias("text"),
    )
    rows = stage(fingerprints(narrow), "fingerprints")
    at = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "digest")
    distinct = stage(rows.groupBy("fp").agg(F.min(at).alias("least")), "distinct-fingerprints")
    roots = connected_components(fingerprint_links(distinct).select("a", "b"))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = named.groupBy("root").agg(F.min("least").alias("first"))
    return rows, named.join(first, "root").select("fp", "first")


def keep_first_of_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of which each is the first of its group of near copies, with all their columns.

    The first row of a group has its smallest id; missing ids sort last and are told apart by a digest of
    the text, so that different texts without an id all stay. Rows that repeat id and text are one row.
    """
    _, groups = _grouped(df, doc_id, text)
    parts = lambda i, digest: F.concat_ws(":", F.coalesce(i.cast("string"), F.lit("-")), F.hex(digest))
    first = groups.select(parts(F.col("first.doc_id"), F.col("first.digest")).alias("key")).distinct()
    key = parts(F.col(f"`{doc_id}`").cast("long"), F.xxhash64(text_of(f"`{text}`")))
    held = df.select(key.alias("key"), F.struct(*[f"`{c}`" for c in df.columns]).alias("r"))
    kept = held.join(first, "key", "left_semi").dropDuplicates(["key"])
    return kept.select(*[F.col(f"r.`{c}`").alias(c) for c in df.columns])


def near_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``fingerprint`` (hexadecimal) and ``component_id``.

    ``component_id`` is the smallest ``doc_id`` that can be reached over fingerprints within the radius,
    the row's own included. Texts without words, missing ones too, have the fingerprint zero and are
    linked like any other. A missing ``doc_id`` is only a component's id where all its ids are missing.
    Repeated rows come as often as they are given; an empty table gives none; other columns are not read.
    """
    rows, groups = _grouped(df, doc_id, text)
    return rows.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.doc_id").alias("component_id")
    )
