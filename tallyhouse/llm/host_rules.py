"""Quality rules of documents, and of the hosts they come from, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import SPACES, WORDS, text_of, words_of
from tallyhouse.sources.staging import stage

LEAST_WORDS = 50
REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 3
# A host fails a rule when more than this share of its documents is expected to fail it.
HOST_LIMIT = 0.5

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def rules() -> dict[str, Column]:
    """Failed rules by name, over the measures. The first two also reject a document by themselves."""
    n, chars = F.col("n_words"), F.col("word_chars")
    return {
        "few_words": n < LEAST_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > REPEAT_PERCENT * n,
        "word_length": (n > 0) & ((chars < 3 * n) | (chars > 10 * n)),
        "symbols": 10 * F.col("n_symbols") > n,
        "dup_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
    }


def _no_chars(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _beside_equal(sorted_items: str, field: str) -> Column:
    """``i`` of the items of a sorted array whose ``field`` equals that of a neighbour."""
    items = F.col(sorted_items)
    last = F.size(items) - 1

    def equal(k: Column) -> Column:
        here = F.get(items, k)[field]
        return ((k > 0) & (F.get(items, k - 1)[field] == here)) | ((k < last) & (F.get(items, k + 1)[field] == here))

    found = F.transform(F.filter(F.sequence(F.lit(0), last), equal), lambda k: F.get(items, k)["i"])
    return F.when(F.size(items) > 1, found).otherwise(F.array().cast("array<int>"))


def measured(df: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """``doc_id``, ``host``, ``n_lines`` (lines with a word) and the measures, one row per row, without a shuffle.

    ``n_repeat_words`` counts the words covered by windows of three words that the text has twice or
    more. Windows are sorted by hash; those beside an equal hash are sorted again as words, so that the
    count is exact and the work stays near the length of the text. A missing text has no words.
    """
    narrow = df.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{host}`").alias("host"), text_of(f"`{text}`").alias("text")
    )
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORDS))
    bare = F.length(F.translate("text", " \t\n\x0b\x0c\r", ""))
    words = narrow.select(
        "doc_id", "host", words_of(F.col("text")).alias("words"), bare.cast("long").alias("word_chars"),
        (F.length("text") - F.length(_no_chars(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    w = F.col("words")

    def hashed(i: Column) -> Column:
        return F.struct(F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW_WORDS)]).alias("h"), i.alias("i"))

    def spelled(i: Column) -> Column:
        return F.struct(F.slice(w, i + 1, WINDOW_WORDS).alias("w"), i.alias("i"))

    windows = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW_WORDS), hashed)
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    # Each step is a projection of its own, so that what it uses several times is worked out once.
    steps = words.withColumn("items", F.sort_array(F.when(F.size(w) >= WINDOW_WORDS, windows).otherwise(none)))
    steps = steps.withColumn("likely", _beside_equal("items", "h")).drop("items")
    steps = steps.withColumn("items", F.sort_array(F.transform("likely", spelled))).drop("likely")
    steps = steps.withColumn("places", _beside_equal("items", "w")).drop("items")
    covered = F.flatten(F.transform("places", lambda i: F.sequence(i, i + (WINDOW_WORDS - 1))))
    return steps.select(
        "doc_id", "host", F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct(covered)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
    )


def host_rates(measures: DataFrame) -> DataFrame:
    """``host``, ``rule``, ``docs``, ``failures`` and ``rate`` per host and rule.

    The rate is the failure rate shrunk to that of all hosts by a beta prior fitted to their rates by
    moments: what the rates vary beyond the chance of the few documents of a host sets how much is
    believed. Where they vary no more than chance does, all hosts get the common rate. Documents without
    a host take no part.
    """
    failed = rules()
    counts = measures.where("host IS NOT NULL").groupBy("host").agg(
        F.count(F.lit(1)).alias("docs"), *[F.count_if(c).alias(f"failed_{r}") for r, c in failed.items()]
    )
    each = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"failed_{r}").alias("failures")) for r in failed])
    long = counts.select("host", "docs", F.inline(each))
    share = F.col("failures") / F.col("docs")
    mean = F.avg(share)
    beyond_chance = F.var_pop(share) - mean * (1 - mean) * F.avg(1 / F.col("docs"))
    prior = long.groupBy("rule").agg(mean.alias("mean"), beyond_chance.alias("spread"))
    strength = F.greatest(F.col("mean") * (1 - F.col("mean")) / F.col("spread") - 1, F.lit(0.0))
    prior = prior.select("rule", "mean", F.when(F.col("spread") > 0, strength).alias("strength"))
    shrunk = (F.col("failures") + F.col("strength") * F.col("mean")) / (F.col("docs") + F.col("strength"))
    # One row per rule: bounded by the rules above.
    return long.join(F.broadcast(prior), "rule").select(
        "host", "rule", "docs", "failures", F.coalesce(shrunk, F.col("mean")).alias("rate")
    )


def judge(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", limit: float = HOST_LIMIT
) -> DataFrame:
    """Measures and verdict of every row: ``base_failed``, ``host_failed`` (its host fails a rule), ``kept``.

    The measures are staged once; per host they are counted before any shuffle, and the verdicts, one row
    per failing host, are joined back in a join that the adaptive plan can split at a host with very many
    documents. Missing texts have no words and fail. Rows without a host are judged alone; repeated
    rows and ids stay as they are; an empty table gives an empty result. Other columns are not read.
    """
    measures = stage(measured(df, doc_id, text, host), "measures")
    failing = host_rates(measures).where(F.col("rate") > limit).select("host").distinct()
    failing = stage(failing, "hosts").withColumn("host_failed", F.lit(True))
    failed = rules()
    base = failed["few_words"] | failed["repeats"]
    judged = measures.join(failing, "host", "left").withColumn("base_failed", base)
    judged = judged.withColumn("host_failed", F.coalesce("host_failed", F.lit(False)))
    return judged.select(
        "doc_id", "host", *MEASURES, "n_lines", "base_failed", "host_failed",
        (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"),
    )
