import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from tests.llm.helpers import documents, given, rows_of, with_clashing_columns

from tallyhouse.llm import mixing


def targets_by_hand(sizes):
    """Share by weight, cut at the cap, and share the excess again until no target is above it."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else rest * weight[s] / free for s in order}
        above = {s for s in order if target[s] > 3 * sizes[s] + 1e-9}
        if not above:
            return target
        capped |= above


def check(df):
    """Targets by hand; words taken within a twentieth of them, or within the smallest document."""
    rows = rows_of(mixing.mix_report(df))
    source = {r.doc_id: r.source for r in df.collect()}
    sizes = defaultdict(int)
    for r in rows:
        sizes[source[r["doc_id"]]] += r["size"]
    target = targets_by_hand(sizes)
    taken, smallest = Counter(), {}
    for r in rows:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
        if r["size"]:
            smallest[s] = min(smallest.get(s, r["size"]), r["size"])
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(smallest.get(s, 0), t / 20) + 1e-6, (s, taken[s], t)
    return rows


def test_given_documents_come_near_their_targets(spark):
    docs = given(spark)
    rows = check(docs)
    assert len(rows) == docs.count()
    key = lambda r: r["doc_id"]
    assert sorted(rows, key=key) == sorted(rows_of(mixing.mix_report(docs.repartition(7))), key=key)
    for r, t in zip(docs.collect(), range(3)):
        assert next(x for x in rows if x["doc_id"] == r.doc_id)["size"] == len(r.text.split())


def test_capped_missing_and_empty_sources(spark):
    texts = [None, "", " \n"] + ["w " * k for k in range(1, 40)] + ["x " * 3000, "one"]
    sources = ["e", "e", "e"] + [["b", "a", None, "ä"][k % 4] for k in range(39)] + ["huge", "tiny"]
    rows = check(with_clashing_columns(documents(spark, texts, sources=sources).withColumn("source", F.col("source"))))
    assert sum(r["taken"] for r in rows) > 0


def test_no_rows_one_row_and_repeats(spark):
    assert rows_of(mixing.mix_report(documents(spark, []))) == []
    assert [r["taken"] for r in rows_of(mixing.mix_report(documents(spark, ["a b c"])))] == [3]
    rows = rows_of(mixing.mix_report(documents(spark, ["a b"] * 6 + ["c d e"], ids=[1] * 6 + [2], sources=["s"] * 6 + ["t"])))
    assert len(rows) == 7


def test_draws_are_disjoint_blocks_with_exact_quotas(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 3)
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 5)
    monkeypatch.setattr(mixing, "STAGE_LEVELS", 2)
    docs = given(spark)
    rows, sources, draws = mixing.plan_mix(docs)
    d = draws.join(rows.select("row", "src", "doc_id"), "row").collect()
    times = Counter(r["row"] for r in d)
    taken = {r["doc_id"]: r["taken"] for r in rows_of(mixing.mix_report(docs))}
    assert {r["doc_id"]: times[r["row"]] * r["size"] for r in rows.collect()} == taken
    assert len({r["shard"] for r in d}) == max(r["shard"] for r in d) + 1 > 4
    per_shard = Counter(r["shard"] for r in d)
    assert max(per_shard.values()) <= 2 * 5 * 3
    assert len({(r["shard"], r["place"]) for r in d}) == len(d)


def test_mixed_table_holds_what_the_report_says(spark):
    docs = given(spark)
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in rows_of(mixing.mix_report(docs)) if r["taken"]}
    mixed = mixing.mix(with_clashing_columns(docs))
    assert dict(Counter(r.doc_id for r in mixed.select("doc_id").collect())) == taken
    assert set(docs.columns) < set(mixed.columns)
    originals = {r.doc_id: r.text for r in docs.collect()}
    assert all(originals[r.doc_id] == r.text for r in mixed.select("doc_id", "text").collect())


def test_hypergeometric_draws_follow_their_distribution(spark):
    total, marked, drawn, n = 40, 15, 12, 4000
    u = (F.col("id") + 0.5) / n
    long = lambda x: F.lit(x).cast("long")
    got = spark.range(n).select(mixing.hypergeometric(long(total), long(marked), long(drawn), u).alias("x"))
    counts = Counter(r.x for r in got.collect())
    for k in range(13):
        p = math.comb(marked, k) * math.comb(total - marked, drawn - k) / math.comb(total, drawn)
        assert abs(counts[k] / n - p) < 1.5 / n + 1e-9
    edges = [(10, 10, 4, 4), (10, 0, 4, 0), (10, 3, 10, 3), (10, 3, 0, 0), (1, 1, 1, 1), (0, 0, 0, 0)]
    for t, k, d, expected in edges:
        assert spark.range(1).select(mixing.hypergeometric(long(t), long(k), long(d), F.lit(0.37))).first()[0] == expected
    big = spark.range(50).select(mixing.hypergeometric(long(10**9), long(3 * 10**8), long(5 * 10**8), (F.col("id") + 0.5) / 50).alias("x"))
    values = [r.x for r in big.collect()]
    assert abs(sum(values) / 50 - 1.5e8) < 2000 and len(set(values)) > 45


def test_quotas_of_the_tree_add_up(spark):
    quotas = spark.createDataFrame([("=a", 70), ("=b", 1), ("=c", 29), ("", 0)], "src string, blocks long")
    found = mixing.split_quotas(quotas, 7, 1).collect()
    by_source = defaultdict(list)
    per_shard = Counter()
    for r in found:
        by_source[r.src] += range(r["first"], r["last"] + 1)
        per_shard[r.shard] += r["last"] - r["first"] + 1
    assert {s: sorted(v) for s, v in by_source.items()} == {"=a": list(range(70)), "=b": [0], "=c": list(range(29))}
    assert set(per_shard) == set(range(7)) and max(per_shard.values()) - min(per_shard.values()) <= 2


def test_same_id_and_text_in_two_sources_keep_their_sources(spark):
    docs = documents(spark, ["w x y"] * 2 + ["v " * 9] * 2, ids=[1, 1, 2, 3], sources=["a", "b", "a", "b"])
    pick = lambda df: {(r.doc_id, r.source) for r in df.collect()}
    report = sum(r["taken"] for r in rows_of(mixing.mix_report(docs)))
    mixed = mixing.mix(docs)
    assert pick(mixed) <= pick(docs) and sum(len(r.text.split()) for r in mixed.collect()) == report
