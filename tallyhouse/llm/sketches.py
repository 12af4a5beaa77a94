"""Document fingerprints: all shingle hashes below a fixed fraction of the hash space."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import text_of, words_of
from tallyhouse.sources.staging import stage

SHINGLE_WORDS = 5
FRACTION_BITS = 2  # hashes below 2**-2 of the hash space stay


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, also where the body uses it in a lambda."""
    return F.transform(F.array(value), body)[0]


def sketch(text: Column) -> Column:
    """Sorted distinct shingle hashes (as unsigned numbers) below the fraction.

    The hash of a shingle of five words is taken over the hashes of its words; a text of fewer words has
    one shingle. Where no hash is below the fraction, the smallest one stays, so that only a text
    without words has an empty sketch.
    """

    def shingles(h: Column) -> Column:
        last = F.greatest(F.size(h) - (SHINGLE_WORDS - 1), F.lit(1))
        each = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(h, i, SHINGLE_WORDS)))
        return F.when(F.size(h) > 0, each).otherwise(F.array().cast("array<bigint>"))

    def below(s: Column) -> Column:
        kept = F.filter(s, lambda x: F.shiftrightunsigned(x, 64 - FRACTION_BITS) == 0)
        # Flipping the sign bit makes signed order the order of unsigned numbers.
        flip = F.lit(-(1 << 63))
        least = F.array_min(F.transform(s, lambda x: x.bitwiseXOR(flip))).bitwiseXOR(flip)
        return F.when((F.size(s) > 0) & (F.size(kept) == 0), F.array(least)).otherwise(F.sort_array(F.array_distinct(kept)))

    hashes = F.transform(words_of(text), lambda w: F.xxhash64(w))
    return let(let(hashes, shingles), below)


def merge(a: Column, b: Column) -> Column:
    """Sketch of two documents together, without looking at their texts again."""
    both = F.array_union(a, b)
    kept = F.filter(both, lambda x: F.shiftrightunsigned(x, 64 - FRACTION_BITS) == 0)
    flip = F.lit(-(1 << 63))
    least = F.array_min(F.transform(both, lambda x: x.bitwiseXOR(flip))).bitwiseXOR(flip)
    return F.when((F.size(both) > 0) & (F.size(kept) == 0), F.array(least)).otherwise(F.sort_array(kept))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has; 1 for an empty ``a``."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles among all of both; 1 for two empty sketches."""
    common = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - common
    return F.when(total == 0, F.lit(1.0)).otherwise(common / total)


def as_text(s: Column) -> Column:
    """A sketch as text: sixteen hexadecimal digits for each hash."""
    return F.array_join(F.transform(s, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def fingerprint(df: DataFrame, text: str = "text", name: str = "sketch") -> DataFrame:
    """Add the sketch of each text; missing texts are empty. A column of that name is replaced."""
    return df.withColumn(name, sketch(text_of(f"`{text}`")))


def _keyed(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows with a key of id and text, so that rows without an id, or with the same one, stay apart."""
    base = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_of(f"`{text}`").alias("text"))
    base = base.withColumn("digest", F.xxhash64("text"))
    return base.withColumn("key", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.hex("digest")))


def followers(rows: DataFrame) -> DataFrame:
    """``key``, ``doc_id``, ``prev_key``, ``prev_chars``: which document each one follows, in a circle.

    Only ids, digests and lengths move. They are dealt by sampled ranges and staged with their places; a
    task then orders one range, and the ends of ranges are joined through one row per range.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.col("digest").asc()]
    narrow = rows.groupBy("key", "doc_id", "digest").agg(F.max(F.length("text")).alias("chars"))
    placed = stage(
        narrow.repartitionByRange(*order).sortWithinPartitions(*order).select(
            "key", "doc_id", "chars", F.monotonically_increasing_id().alias("place")
        ),
        "places",
    ).withColumn("part", F.shiftrightunsigned("place", 33))
    ends = placed.groupBy("part").agg(F.max_by(F.struct("key", "chars"), "place").alias("last"))
    by_part = Window.orderBy("part")
    whole = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("part", F.coalesce(F.lag("last").over(by_part), F.last("last").over(whole)).alias("border"))
    inside = Window.partitionBy("part").orderBy("place")
    before = F.coalesce(F.lag(F.struct("key", "chars")).over(inside), F.col("border"))
    return placed.join(ends, "part").select("key", "doc_id", before.alias("p")).select(
        "key", "doc_id", F.col("p.key").alias("prev_key"), F.col("p.chars").alias("prev_chars")
    )


def compare_with_next(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint each text, its edited text and the next text, and compare them.

    The next document is that of the next ``doc_id``, after the last one the first. The edited text has
    its last ``floor(n_chars / 4)`` code points replaced by the first as many of the next text, or all
    where that is shorter. A text moves once to meet its predecessor's key, and then only the part that
    the predecessor takes, with the sketch.

    Missing texts are empty, and a missing ``doc_id`` sorts first. Texts that share an id are ordered by a
    digest; rows that repeat id and text are one document in that order and come back as often as
    given. A single document is its own next. An empty table gives no rows.
    """
    rows = _keyed(df, doc_id, text)
    chain = stage(followers(rows), "followers")
    # Both uses of this join read the same exchange of key and text; all else comes from the chain.
    met = rows.select("key", "text").join(chain, "key")
    given = met.select(
        F.col("prev_key").alias("key"),
        F.substring(F.col("text"), F.lit(1), F.floor(F.col("prev_chars") / 4).cast("int")).alias("given"),
        sketch(F.col("text")).alias("next_sketch"),
    ).dropDuplicates(["key"])
    n = F.length("text")
    edited = met.join(given, "key").select(
        "doc_id",
        "text",
        F.concat(F.substring(F.col("text"), F.lit(1), (n - F.floor(n / 4)).cast("int")), "given").alias("edited"),
        "next_sketch",
    )
    sketched = edited.select(
        "doc_id", "text", "edited", "next_sketch",
        sketch(F.col("text")).alias("own_sketch"), sketch(F.col("edited")).alias("edited_sketch"),
    )
    return sketched.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("own_sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("own_sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("own_sketch"), F.col("next_sketch")).alias("near_next"),
    )
