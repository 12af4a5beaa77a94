"""Repeated passages: chunks of lines with boundaries that the content chooses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import text_of, words_of
from tallyhouse.llm.sketches import let
from tallyhouse.sources.staging import stage

WINDOW_LINES = 2  # lines that a rolling hash covers
RUN_WORDS = 50  # words from which a run of lines counts as a passage, wherever chunks end


def _bounds(lines: Column) -> Column:
    """Array of the numbers of lines before each chunk and at the end."""
    n = F.size(lines)

    def bounds(r: Column) -> Column:
        inner = F.filter(
            F.sequence(F.lit(2), F.greatest(n - 1, F.lit(2))),
            lambda i: (i < n) & (F.get(r, i - 1) < F.get(r, i - 2)) & (F.get(r, i - 1) < F.get(r, i)),
        )
        return F.concat(F.array(F.lit(0)), inner, F.array(n))

    def rolled(h: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), n),
            lambda i: F.xxhash64(F.slice(h, F.greatest(i - (WINDOW_LINES - 1), F.lit(1)), F.least(i, F.lit(WINDOW_LINES)))),
        )

    return let(let(F.transform(lines, lambda x: F.xxhash64(x)), rolled), bounds)


def line_chunks(text: Column) -> Column:
    """Array of (``no``, ``lines``, ``body``): the chunks of a text, in order and without gaps.

    A chunk ends after a line whose rolling hash (over the hashes of its last two lines) is smaller than
    those of the lines before and after it. So the boundaries depend on the neighbouring lines alone,
    move with them when text is put in elsewhere, and no chunk but the last has less than two lines.
    """

    def cut(lines: Column) -> Column:
        def bodies(b: Column) -> Column:
            return F.transform(
                F.sequence(F.lit(1), F.size(b) - 1),
                lambda k: F.struct(
                    k.alias("no"),
                    (F.get(b, k) - F.get(b, k - 1)).alias("lines"),
                    F.array_join(F.slice(lines, F.get(b, k - 1) + 1, F.get(b, k) - F.get(b, k - 1)), "\n").alias("body"),
                ),
            )

        return let(_bounds(lines), bodies)

    return let(F.split(text, "\n", -1), cut)


def _span(start: Column, lines: Column) -> Column:
    """The first line (from one) and the number of lines, as one whole number that sorts by the first."""
    return F.shiftleft(start.cast("long"), 32).bitwiseOR(lines.cast("long"))


def _start(span: Column) -> Column:
    return F.shiftright(span, 32).cast("int")


def _lines(span: Column) -> Column:
    return span.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")


def _runs(lines: Column, words: int) -> Column:
    """Spans of the shortest runs of neighbouring lines with so many words that start or end at some line.

    A line weighs as many words as it has, an empty one as one, so no run has more than ``words`` lines.
    Every passage of whole lines with so many words is covered by the runs inside it.
    """

    def shortest(weights: Column) -> Column:
        return F.aggregate(
            weights, F.struct(F.lit(0).alias("w"), F.lit(0).alias("m")),
            lambda a, x: F.when(a["w"] >= words, a).otherwise(F.struct((a["w"] + x).alias("w"), (a["m"] + 1).alias("m"))),
            lambda a: F.when(a["w"] >= words, a["m"]),
        )

    def spans(weights: Column) -> Column:
        def ending(i: Column) -> Column:
            low = F.greatest(i - (words - 1), F.lit(1))
            before = F.reverse(F.slice(weights, low, i - low + 1))
            return let(shortest(before), lambda m: _span(i - m + 1, m))

        numbers = F.sequence(F.lit(1), F.size(weights))
        begin = F.transform(numbers, lambda i: let(shortest(F.slice(weights, i, F.lit(words))), lambda m: _span(i, m)))
        return F.filter(F.concat(begin, F.transform(numbers, ending)), lambda s: s.isNotNull())

    return let(F.transform(lines, lambda x: F.greatest(F.size(words_of(x)), F.lit(1))), spans)


def _passages(lines: Column, run_words: int | None) -> Column:
    """Spans of the chunks of two lines or more and, with ``run_words``, of the runs of so many words."""

    def spans(b: Column) -> Column:
        chunks = F.transform(
            F.sequence(F.lit(1), F.size(b) - 1), lambda k: _span(F.get(b, k - 1) + 1, F.get(b, k) - F.get(b, k - 1))
        )
        return F.filter(chunks, lambda s: _lines(s) > 1)

    chunks = let(_bounds(lines), spans)
    return F.array_union(chunks, _runs(lines, run_words)) if run_words else chunks


def remove_repeated_chunks(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", run_words: int | None = None
) -> DataFrame:
    """Remove chunks of two lines or more that came before; adds ``removed_lines``.

    Of equal chunks over all documents, the one of the smallest ``doc_id`` stays, and in a document the
    first one. With ``run_words``, the lines of every passage of whole lines with so many words that came
    before go as well, however few lines it has and wherever chunks end: its runs are compared as chunks
    are, and one that overlaps the first copy in the same document stays. A line that goes always has an
    equal one that stays.

    Hashes only propose: per chunk one number is shuffled and counted, with a partial count
    in each task. The texts of proposed chunks are then compared byte by byte, as grouping and join keys,
    and what the join finds goes back to its document. A chunk in a third of all documents is one row
    per task in the grouping, and one that the adaptive plan splits in the joins.

    Missing texts stay missing and remove nothing; empty texts have one empty line and stay. Rows that share
    an id are ordered by digests of text and row; rows that are equal in everything are one document and
    keep the same chunks. Columns named ``removed_lines`` are replaced; others stay as they are. An
    empty table gives an empty one.
    """
    columns = [c for c in df.columns if c.lower() != "removed_lines"]
    plain = [f"`{c}`" for c in columns]
    body = text_of(f"`{text}`")
    key = F.concat_ws(":", F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("-")), F.hex(F.xxhash64(body)))
    rows = df.select(key.alias("__key"), F.struct(*plain).alias("__row"))
    whole = text_of(f"__row.`{text}`")

    cut = lambda body: let(F.split(whole, "\n", -1), body)
    join = lambda lines, s: F.array_join(F.slice(lines, _start(s), _lines(s)), "\n")
    hashed = cut(lambda lines: F.transform(
        _passages(lines, run_words), lambda s: F.struct(s.alias("span"), F.xxhash64(join(lines, s)).alias("hash"))
    ))
    numbers = rows.select("__key", F.explode(hashed).alias("c")).select("__key", "c.span", "c.hash")
    repeated = numbers.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash")
    repeated = stage(repeated, "repeated-hashes")  # a table of its own: a join with it can be split
    proposed = numbers.join(repeated, "hash", "left_semi").groupBy("__key").agg(F.collect_set("span").alias("__spans"))
    proposed = stage(proposed, "proposed-passages")  # read twice below

    met = rows.join(proposed, "__key")
    order = F.struct(
        F.col(f"__row.`{doc_id}`").cast("long").alias("id"), F.col("__key").alias("key"),
        F.xxhash64(*[F.col(f"__row.{c}") for c in plain]).alias("row"),
    )
    candidates = met.select(
        "__key",
        order.alias("order"),
        F.explode(cut(lambda lines: F.transform(
            "__spans", lambda s: F.struct(s.alias("span"), join(lines, s).alias("body"))
        ))).alias("c"),
    ).select("__key", F.struct(F.col("order"), F.col("c.span").alias("span")).alias("at"), F.col("c.body").alias("body"))
    first = candidates.groupBy("body").agg(F.min("at").alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = stage(first.select("body", "kept"), "first-chunks")
    later = candidates.join(first, "body").where("at > kept").where(
        (F.col("at.order") != F.col("kept.order"))
        | (_start(F.col("at.span")) >= _start(F.col("kept.span")) + _lines(F.col("kept.span")))
    )
    gone = later.groupBy("__key").agg(F.collect_set(F.struct(F.col("at.order.row").alias("row"), F.col("at.span").alias("span"))).alias("__gone"))

    here = F.xxhash64(*[F.col(f"__row.{c}") for c in plain])
    joined = rows.join(gone, "__key", "left").select(
        "__row", F.transform(F.filter("__gone", lambda g: g["row"] == here), lambda g: g["span"]).alias("__spans")
    )
    covered = F.flatten(F.transform(
        "__spans", lambda s: F.sequence(_start(s), _start(s) + _lines(s) - 1)
    ))
    new = cut(lambda lines: let(
        F.array_except(F.sequence(F.lit(1), F.size(lines)), covered),
        lambda kept: F.struct(
            F.array_join(F.transform(kept, lambda k: F.get(lines, k - 1)), "\n").alias("text"),
            (F.size(lines) - F.size(kept)).cast("long").alias("lines"),
        ),
    ))
    split = joined.select("__row", F.when(F.size("__spans") > 0, new).alias("__new"))
    return split.select(
        *[
            F.when(F.col("__new").isNull(), F.col(f"__row.`{c}`")).otherwise(F.col("__new.text")).alias(c)
            if c == text
            else F.col(f"__row.`{c}`").alias(c)
            for c in columns
        ],
        F.coalesce("__new.lines", F.lit(0).cast("long")).alias("removed_lines"),
    )
