"""What several operators of this subpackage share: words, order, Arrow passes and shared files."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# White space and words as every operator here takes them.
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"

# Bytes of text that an Arrow pass works on at once.
SLICE_BYTES = 4 << 20
PASS_BYTES = 1 << 20  # for passes that append columns: words and ids of a slice take a multiple of its bytes

# Totals that one task of the upper level of a running sum adds up.
BLOCK = 1024


# What an entry of a cache takes besides its bytes: key, tuple and two byte strings, and its place in the table.
ENTRY_BYTES = 320


class Recent:
    """What was worked out for byte strings, in two generations of half the bound each.

    When the young one is full it becomes the old one, and the old one is let go; what is asked for again
    moves to the young one. So the memory is bounded, and frequent entries stay. One that has grown beyond
    the whole bound is let go at once.
    """

    def __init__(self, bound: int, most: int = 1 << 40):
        self.bound, self.most, self.size = bound, most, 0
        self.young: dict[bytes, object] = {}
        self.old: dict[bytes, object] = {}

    def missing(self, wanted: Collection[bytes]) -> list[bytes]:
        """Those not known, of distinct ones; all others are in ``young`` after this, until the next call."""
        if self.size > self.bound // 2 or len(self.young) > self.most // 2:
            self.young, self.old, self.size = {}, self.young if self.size <= self.bound else {}, 0
        young, old = self.young, self.old
        new = [key for key in wanted if key not in young]
        if not old:
            return new
        for key in new:
            if key in old:
                self.put(key, old[key])
        return [key for key in new if key not in young]

    def __len__(self) -> int:
        return len(self.young) + len(self.old)

    def put(self, key: bytes, value) -> None:
        self.young[key] = value
        self.size += ENTRY_BYTES + len(key) + (len(value) if isinstance(value, bytes) else sum(map(len, value)))

    def put_all(self, keys: list[bytes], values: list[bytes]) -> None:
        self.young.update(zip(keys, values, strict=True))
        self.size += ENTRY_BYTES * len(keys) + sum(map(len, keys)) + sum(map(len, values))


def text_of(name: str = "text") -> Column:
    """The text, where missing counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text; empty for a text without any."""
    return F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``limit`` bytes of one text column, or one row."""
    texts = batch.column(column)
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    begin = total = 0
    for row, size in enumerate(lengths):
        if total and total + size > limit:
            yield batch.slice(begin, row - begin)
            begin, total = row, 0
        total += int(size)
    if begin < batch.num_rows:
        yield batch.slice(begin)


def append_columns(
    df: DataFrame, text: str, fields: list[T.StructField], compute: Callable[[list[str]], list], drop: tuple[str, ...] = ()
) -> DataFrame:
    """Add columns computed from a text column in one Arrow pass, without a shuffle.

    ``compute`` gets the texts of a bounded slice (missing ones as empty) and returns one array or
    list per field. A column of the frame that has the name of a new one is replaced by it.
    """
    taken = {f.name.lower() for f in fields}
    gone = {x.lower() for x in drop}
    kept = [f for f in df.schema.fields if f.name.lower() not in taken and f.name.lower() not in gone]
    names = [f.name for f in kept]
    inner = [f"column_{k}" for k in range(len(names))]  # whatever a frame's columns are called, dots included
    source = df.select(*[F.col(f"`{n}`").alias(x) for n, x in zip(names, inner)], F.col(f"`{text}`").alias("text"))
    kinds = [_arrow(f.dataType) for f in fields]
    labels = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", PASS_BYTES):
                made = compute([x or "" for x in part.column("text").to_pylist()])
                arrays = [x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, k) for x, k in zip(made, kinds)]
                yield pa.RecordBatch.from_arrays([part.column(x) for x in inner] + arrays, names + labels)
        # The worker stays for later passes, of other operators too: what Arrow keeps for itself goes back.
        pa.default_memory_pool().release_unused()

    return source.mapInArrow(run, T.StructType(kept + fields))


def _arrow(kind: T.DataType) -> pa.DataType:
    plain = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(), T.StringType: pa.string(),
             T.BooleanType: pa.bool_(), T.BinaryType: pa.binary()}
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    return plain[type(kind)]


def sums_before(totals: DataFrame, order: str, *values: str) -> DataFrame:
    """Add ``before_<value>``: the sum over all rows with a smaller ``order`` (a whole number, unique).

    For tables of totals (one row per file, block or bucket). Blocks of consecutive numbers are summed
    first, so no task gets more than the blocks or one block.
    """
    block = F.floor(F.col(order) / BLOCK)
    blocks = totals.groupBy(block.alias("__block")).agg(*[F.sum(v).alias(f"__{v}") for v in values])
    over = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("__block", *[F.coalesce(F.sum(f"__{v}").over(over), F.lit(0)).alias(f"__{v}") for v in values])
    inside = Window.partitionBy("__block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        totals.withColumn("__block", block)
        .join(blocks, "__block")
        .select(
            *[F.col(c) for c in totals.columns],
            *[(F.col(f"__{v}") + F.coalesce(F.sum(v).over(inside), F.lit(0))).alias(f"before_{v}") for v in values],
        )
    )


def filesystem(path: str):
    """The file system of a path or address, and the path in it (executors write through it)."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)
