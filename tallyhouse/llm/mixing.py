"""Mixing sources to target weights: exact block quotas, split among output shards by a tree of draws."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import WORDS, text_of
from tallyhouse.llm.sketches import let
from tallyhouse.sources.staging import stage

WEIGHTS = (1, 2, 3)  # by source in code point order, repeating
CAP = 3  # times its size that a source may be taken
SEED = 20240501

BLOCK_DOCS = 64  # drawn documents of a block
SHARD_BLOCKS = 64  # blocks of an output shard
STRIDE = 2147483647  # a prime, so that its multiples visit every block of a source once
RANK_BITS = 12  # of a hash: so many buckets that a hot source or size is ranked in
STAGE_LEVELS = 6


def source_key(source: Column) -> Column:
    """A source as a join key that a missing one has, too."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def ranked(rows: DataFrame, keys: list[str], by: str, tie: str, name: str) -> DataFrame:
    """Add the rank (from 0) within ``keys`` by a hash column, then by ``tie``.

    The leading bits of the hash cut every group into buckets; buckets are counted and summed up first,
    so that no task orders more than one bucket of a group.
    """
    bucketed = rows.withColumn("__bucket", F.shiftright(by, 64 - RANK_BITS))
    counts = bucketed.groupBy(*keys, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*keys, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*keys, "__bucket").orderBy(by, tie)
    placed = bucketed.withColumn("__inside", F.row_number().over(inside) - 1)
    return placed.join(counts, [*keys, "__bucket"]).select(
        *[F.col(c) for c in rows.columns], (F.col("__before") + F.col("__inside")).alias(name)
    )


def target_words(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """Add ``target`` to a table of sources (``src``, ``source_size``).

    All words are shared by weight; a target stops at ``cap`` times its source's size, and the excess is
    shared by weight among the others until none is above. That is: with sources in order of cap over
    weight, the first few are capped, and the rest share what is left. Windows run over one row per
    source.
    """
    order = F.row_number().over(Window.orderBy((F.col("src") == "").asc(), "src"))
    weighed = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (order - 1) % len(weights) + 1))
    weighed = weighed.withColumn("most", (F.col("source_size") * cap).cast("double"))
    weighed = weighed.withColumn("ratio", F.col("most") / F.col("w"))
    earlier = Window.orderBy("ratio", "src").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))) / (
        F.sum("w").over(whole) - F.coalesce(F.sum("w").over(earlier), F.lit(0.0))
    )
    levels = weighed.withColumn("level", level)
    # The first source that its share does not fill ends the capped ones, and sets the level of the rest.
    fits = F.min(F.when(F.col("level") * F.col("w") <= F.col("most"), F.struct("ratio", "src", "level"))).over(whole)
    levels = levels.withColumn("end", fits)
    capped = F.struct("ratio", "src") < F.struct(F.col("end.ratio"), F.col("end.src"))
    return levels.select(
        "src", "source_size", F.when(capped, F.col("most")).otherwise(F.col("end.level") * F.col("w")).alias("target")
    )


def draws_by_size(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``src``, ``size``, ``passes``, ``draws``: how often all documents of a size are taken, and how many of
    them once more.

    From the largest size down, as many are drawn as bring the words taken nearest to their share, so
    that what is left over is less than a small document. The fold runs over the distinct sizes of a
    source, whose number the length of documents bounds.
    """
    by_size = rows.groupBy("src", "size").agg(F.count(F.lit(1)).alias("n"))
    passes = F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0)))
    lists = by_size.groupBy("src").agg(F.sort_array(F.collect_list(F.struct("size", "n")), asc=False).alias("sizes"))
    lists = lists.join(sources, "src").withColumn("passes", passes.cast("long"))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") - F.col("passes")).otherwise(F.lit(0.0))
    start = F.struct(
        F.lit(0.0).alias("due"), F.lit(0).cast("long").alias("taken"), F.array().cast("array<bigint>").alias("draws")
    )

    def step(state: Column, x: Column) -> Column:
        due = state["due"] + x["size"] * x["n"] * F.col("share")
        m = F.floor(F.when(x["size"] > 0, (due - state["taken"]) / x["size"]).otherwise(x["n"] * F.col("share")) + 0.5)
        return let(F.greatest(F.lit(0).cast("long"), F.least(m, x["n"])), lambda d: F.struct(
            due.alias("due"), (state["taken"] + d * x["size"]).alias("taken"), F.concat(state["draws"], F.array(d)).alias("draws")
        ))

    folded = lists.withColumn("share", share).withColumn("draws", F.aggregate("sizes", start, step, lambda s: s["draws"]))
    return folded.select("src", "passes", F.explode(F.arrays_zip("sizes", "draws")).alias("z")).select(
        "src", F.col("z.sizes.size").alias("size"), "passes", F.col("z.draws").alias("draws")
    )


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` out of ``total`` are among the ``marked``: the draw that ``u`` (0 to 1) picks.

    Inversion outwards from the most likely number, by the ratios of neighbouring probabilities; twelve
    standard deviations on either side hold all of them but what a double number cannot show.
    """
    big, zero = "double", F.lit(0).cast("long")

    def window(p: Column) -> Column:
        t, k, n = p["t"], p["k"], p["n"]
        low, high = F.greatest(zero, n - (t - k)), F.least(n, k)
        mode = F.floor((n + 1).cast(big) * (k + 1).cast(big) / (t + 2).cast(big)).cast("long")
        spread = F.sqrt(
            n.cast(big) * k.cast(big) / F.greatest(t, F.lit(1)).cast(big) * (t - k).cast(big) / F.greatest(t, F.lit(1)).cast(big)
            * (t - n).cast(big) / F.greatest(t - 1, F.lit(1)).cast(big)
        )
        reach = F.ceil(spread * 12).cast("long") + 12
        return let(F.struct(low.alias("low"), high.alias("high"), F.least(F.greatest(mode, low), high).alias("mode"), reach.alias("reach")),
                   lambda w: walk(t, k, n, w))

    def walk(t: Column, k: Column, n: Column, w: Column) -> Column:
        top, bottom = F.least(w["high"], w["mode"] + w["reach"]), F.greatest(w["low"], w["mode"] - w["reach"])
        none = F.array().cast("array<bigint>")
        up = F.when(top > w["mode"], F.sequence(w["mode"] + 1, top)).otherwise(none)
        down = F.when(bottom < w["mode"], F.sequence(w["mode"] - 1, bottom, F.lit(-1).cast("long"))).otherwise(none)

        def rise(x: Column) -> Column:
            return (k - x + 1).cast(big) * (n - x + 1).cast(big) / (x.cast(big) * (t - k - n + x).cast(big))

        def fall(x: Column) -> Column:
            return (x + 1).cast(big) * (t - k - n + x + 1).cast(big) / ((k - x).cast(big) * (n - x).cast(big))

        def add(ratio):
            def one(s: Column, x: Column) -> Column:
                return let(s["p"] * ratio(x), lambda p: F.struct(
                    p.alias("p"), (s["sum"] + p).alias("sum"),
                    F.when(s["pick"].isNull() & (s["sum"] + p >= s["goal"]), x).otherwise(s["pick"]).alias("pick"),
                    s["goal"].alias("goal"),
                ))
            return one

        def state(sum_: Column, pick: Column, goal: Column) -> Column:
            return F.struct(F.lit(1.0).alias("p"), sum_.alias("sum"), pick.alias("pick"), goal.alias("goal"))

        def all_of(goal: Column) -> Column:
            first = F.when(goal <= 1.0, w["mode"])
            risen = F.aggregate(up, state(F.lit(1.0), first, goal), add(rise))
            return let(risen, lambda r: F.aggregate(down, state(r["sum"], r["pick"], goal), add(fall)))

        never = F.lit(float("inf"))
        return let(all_of(never)["sum"], lambda s: F.coalesce(all_of(u * s)["pick"], w["mode"]))

    return let(F.struct(total.alias("t"), marked.alias("k"), drawn.alias("n")), window)


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """``shard``, ``src``, ``first``, ``last``: which blocks of a source (in permuted order) a shard gets.

    A node of the tree holds a range of shards and the blocks of each source for them. Half of its shards
    get their share of the blocks, drawn from the sources without replacement: one hypergeometric draw
    for each source, of what the earlier ones left. Quotas add up exactly at every node. Nodes are rows;
    the tree is staged and dealt anew every few levels.
    """
    listed = quotas.agg(F.sort_array(F.collect_list(F.struct("src", "blocks"))).alias("q"))
    names = listed.select(F.posexplode("q.src").alias("number", "src"))
    nodes = listed.select(
        F.lit(0).cast("long").alias("shard"), F.lit(shards).cast("long").alias("shards"), F.col("q.blocks").alias("blocks")
    )
    sum_of = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)

    def left_blocks() -> Column:
        total = sum_of(F.col("blocks"))
        start = F.struct(
            total.alias("total"),
            F.floor(total.cast("double") * F.floor(F.col("shards") / 2) / F.col("shards")).cast("long").alias("open"),
            F.array().cast("array<bigint>").alias("out"),
        )

        def step(s: Column, c: Column) -> Column:
            number = F.xxhash64(F.lit(seed), F.col("shard"), F.col("shards"), F.size(s["out"]))
            u = (F.shiftrightunsigned(number, 11).cast("double") + 0.5) / float(1 << 53)
            return let(hypergeometric(s["total"], c, s["open"], u), lambda x: F.struct(
                (s["total"] - c).alias("total"), (s["open"] - x).alias("open"), F.concat(s["out"], F.array(x)).alias("out")
            ))

        return F.aggregate("blocks", start, step, lambda s: s["out"])

    for level in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        if level % STAGE_LEVELS == STAGE_LEVELS - 1:
            nodes = stage(nodes.repartition("shard"), "mix-tree")
        half = F.floor(F.col("shards") / 2).cast("long")
        halves = nodes.withColumn("left", F.when(F.col("shards") > 1, left_blocks()))
        children = F.when(F.col("shards") == 1, F.array(F.struct("shard", "shards", "blocks"))).otherwise(F.array(
            F.struct(F.col("shard"), half.alias("shards"), F.col("left").alias("blocks")),
            F.struct(
                (F.col("shard") + half).alias("shard"), (F.col("shards") - half).alias("shards"),
                F.zip_with("blocks", "left", lambda a, b: a - b).alias("blocks"),
            ),
        ))
        nodes = halves.select(F.explode(children).alias("c")).select("c.*")
    per_source = nodes.select("shard", F.posexplode("blocks").alias("number", "n")).join(names, "number")
    up_to = Window.partitionBy("src").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n").over(up_to), F.lit(0))
    return per_source.select("shard", "src", first.alias("first"), (first + F.col("n") - 1).alias("last")).where("last >= first")


def plan_mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED):
    """Tables of the mix: ``rows`` (one per document), ``sources`` and ``draws`` (one per document taken).

    ``rows`` has ``row``, ``key`` (id, text and source), ``doc_id``, ``src``, ``size`` in words. ``sources`` has ``src``,
    ``source_size``, ``target``. ``draws`` has ``row``, ``key``, ``size``, ``shard`` and ``place`` (its order in the
    shard): a document comes once per pass over its source, and once more if drawn. Only these narrow
    tables are shuffled. All choices are hashes of seed, id and text, so reruns agree.
    """
    base = df.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_of(f"`{text}`").alias("text"),
        source_key(F.col(f"`{source}`")).alias("src"),
    )
    digest = F.xxhash64("text")
    rows = stage(
        base.select(
            F.monotonically_increasing_id().alias("row"),
            F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.hex(F.xxhash64("text", "src"))).alias("key"),
            "doc_id", "src", F.regexp_count("text", F.lit(WORDS)).cast("long").alias("size"),
            F.xxhash64(F.lit(seed), "doc_id", digest, "src").alias("mix"),
        ),
        "mix-rows",
    )
    sizes = rows.groupBy("src").agg(F.sum("size").alias("source_size"))
    sources = stage(target_words(sizes), "mix-sources")

    by_size = stage(draws_by_size(rows, sources), "mix-by-size")  # a table of its own: its join can be split
    ordered = ranked(rows, ["src", "size"], "mix", "row", "rank").join(by_size, ["src", "size"])
    times = (F.col("passes") + F.when(F.col("rank") < F.col("draws"), 1).otherwise(0)).cast("int")
    taken = ordered.withColumn("times", times).where("times > 0")
    copies = taken.select("row", "key", "src", "size", "mix", F.explode(F.sequence(F.lit(1), "times")).alias("pass"))
    copies = copies.withColumn("order", F.xxhash64("mix", "pass"))
    copies = stage(ranked(copies, ["src"], "order", "row", "number"), "mix-copies")

    quotas = stage(
        copies.groupBy("src").agg(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS).cast("long").alias("blocks")), "mix-quotas"
    )
    total = quotas.agg(F.sum("blocks")).first()[0] or 0
    shards = max(1, -(-total // SHARD_BLOCKS))
    placed = split_quotas(quotas, shards, seed).select(
        "shard", "src", F.explode(F.sequence("first", "last")).alias("at")
    )
    blocks = copies.join(quotas, "src").withColumn("block", F.floor(F.col("number") / BLOCK_DOCS))
    at = F.pmod(F.pmod(F.lit(STRIDE), F.col("blocks")) * F.col("block") + F.pmod(F.xxhash64(F.lit(seed), "src"), F.col("blocks")), "blocks")
    draws = blocks.withColumn("at", at).join(placed, ["src", "at"]).select(
        "row", "key", "size", "shard", F.xxhash64(F.lit(seed + 1), "order").alias("place")
    )
    return rows, sources, draws


def mix_report(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """One row per input row: ``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` (words the mix takes).

    Missing texts have size 0; a missing source is a source of its own, the last one. A source without
    words has the target 0. Rows that repeat are documents of their own. An empty table gives no rows.
    """
    rows, sources, draws = plan_mix(df, doc_id, text, source, seed)
    taken = draws.groupBy("row").agg(F.sum("size").alias("taken"))
    return rows.join(taken, "row", "left").join(sources, "src").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """The mixed table: every row as often as the mix takes it, dealt to shards and shuffled in them.

    A task of the result holds whole shards, each in its own random order; ``shard`` and ``place`` are
    dropped, other columns stay. Rows that repeat id, text and source are told apart only by number: their
    draws are added up and given to one of them.
    """
    _, _, draws = plan_mix(df, doc_id, text, source, seed)
    content = F.xxhash64(text_of(f"`{text}`"), source_key(F.col(f"`{source}`")))
    key = F.concat_ws(":", F.coalesce(F.col(f"`{doc_id}`").cast("long").cast("string"), F.lit("-")), F.hex(content))
    held = df.select(key.alias("key"), F.struct(*[f"`{c}`" for c in df.columns]).alias("r")).dropDuplicates(["key"])
    return (
        draws.join(held, "key")
        .repartition("shard")
        .sortWithinPartitions("shard", "place", "key")
        .select(*[F.col(f"r.`{c}`").alias(c) for c in df.columns])
    )
