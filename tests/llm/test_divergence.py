import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from hypothesis import given as examples
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.llm.helpers import documents, given, with_clashing_columns

from tallyhouse.llm import divergence
from tallyhouse.llm.transducer import Transducer

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def by_hand(rows, least=10):
    documents_with, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        found = terms(text)
        documents_with[lang or ""].update(set(found))
        counts[lang or "", source or ""].update(found)
    out = []
    for lang in {g for g, _ in counts}:
        kept = [t for t, n in documents_with[lang].items() if n >= least]
        groups = {s: c for (g, s), c in counts.items() if g == lang}

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in groups.items()}
        q = shares(sum(groups.values(), Counter()))
        for s in groups:
            pair = sorted((-sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o.encode()) for o in groups if o != s)
            term = sorted(
                (-((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])), t.encode()) for t in kept if groups[s][t] and p[s][t] > q[t]
            )[:10]
            for part, ranked in (("pair", pair), ("term", term)):
                out += [(lang, s, part, item.decode(), -v, k) for k, (v, item) in enumerate(ranked, 1)]
    return sorted(out)


def found(df, **options):
    return sorted(tuple(r) for r in divergence.source_divergence(df, **options).collect())


def triples(df):
    return [(r.lang, r.source, r.text) for r in df.select("lang", "source", "text").collect()]


@settings(max_examples=60, deadline=None)
@examples(st.lists(st.text("abcé\U0001f642", max_size=6).filter(bool), max_size=60), st.lists(st.text("abcdé", max_size=7), max_size=30))
def test_ordinals_of_any_sorted_terms(words, others):
    sorted_terms = sorted({w.encode() for w in words})
    t = Transducer(sorted_terms)
    asked = sorted_terms + [o.encode() for o in others]
    place = {w: k for k, w in enumerate(sorted_terms)}
    # A slice of a larger array: its buffers do not begin with its first term.
    array = pa.array([b"zz", *asked, b"q"], pa.binary()).slice(1, len(asked))
    assert t.ordinals(array).tolist() == [place.get(a, -1) for a in asked]
    assert t.size == len(sorted_terms)


def test_transducer_is_minimal():
    """All words of three letters out of ab: one state for each number of letters left."""
    words = sorted(a + b + c for a in (b"a", b"b") for b in (b"a", b"b") for c in (b"a", b"b"))
    assert Transducer(words).states == 4
    endings = sorted(stem + end for stem in (b"talk", b"walk") for end in (b"", b"ed", b"ing", b"s"))
    right = len({frozenset(w[len(p):] for w in endings if w.startswith(p)) for p in {w[:k] for w in endings for k in range(len(w) + 1)}})
    assert Transducer(endings).states == right
    with pytest.raises(ValueError):
        Transducer([b"b", b"a"])


def test_given_documents(spark, conf):
    docs = given(spark).withColumn("source", F.when(F.col("doc_id") % 5 > 0, F.col("source")))
    expected = by_hand(triples(docs))
    assert len(expected) > 300
    assert found(docs.repartition(4)) == expected


def test_many_shards_tiles_buckets_and_blocks(spark, conf, monkeypatch):
    conf(spark__sql__shuffle__partitions="7", spark__sql__execution__arrow__maxRecordsPerBatch="37",
         spark__sql__autoBroadcastJoinThreshold="-1")
    for name, value in {"SHARD_TERMS": 5, "TILE": 3, "BUCKETS": 4, "SALTS": 2}.items():
        monkeypatch.setattr(divergence, name, value)
    docs = given(spark).where("lang IN ('de', 'es')")
    assert found(docs.repartition(6)) == by_hand(triples(docs))


def test_blocks_of_terms_and_missing_shares():
    pair = divergence._TilePair(["en", 0, 0, 0], 256)
    pair.header = [(1, 7), (0, 5)]
    for k in range(1200):
        pair.add(k, k % 2, 100 + k)
    got = dict(zip(zip(pair.result().column("a").to_pylist(), pair.result().column("b").to_pylist()), pair.result().column("part").to_pylist()))
    by_term = [((100 + k) - (5 if k % 2 else 7)) ** 2 // (100 + k + (5 if k % 2 else 7)) for k in range(1200)]
    assert got == {(0, 1): sum(by_term), (1, 0): sum(by_term)}


def test_odd_texts_languages_and_sources(spark):
    texts = [None, "", "...", "a-b_c1d", "ÉCLAIR Éclair éclair", "x" * 200_000, "\x7f\x80 Ā z", "only", "here here here", "\U0001f642é"]
    texts = [t for t in texts for _ in range(3)]
    docs = with_clashing_columns(documents(spark, texts, sources=[None, "", "s1", "s2", "é", "z"] * 5))
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 4 == 0, None).when(F.col("doc_id") % 4 == 1, "").otherwise("en"))
    docs = docs.withColumn("term", F.lit("x")).withColumn("ord", F.lit(3))
    for least in (1, 2, 10):
        assert found(docs, least=least) == by_hand(triples(docs), least)


def test_no_rows_one_source_and_no_kept_term(spark):
    assert found(documents(spark, [])) == []
    assert found(documents(spark, ["a b"] * 12, sources=["s"] * 12)) == []
    two = found(documents(spark, ["a", "b"], sources=["s", "t"]))
    assert two == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_large_counts_are_exact(spark):
    big = 10**13
    row = spark.createDataFrame([(big, 3 * big + 1, 17)], "c long, n long, v long")
    assert row.select(divergence.share(F.col("c"), F.col("n"), F.col("v"))).first()[0] == 1 + 10**9 * (big + 2) // (3 * big + 1 + 34)


def test_filter_holds_all_kept_terms_and_little_else(spark):
    rows = [("en", f"w{k}é") for k in range(3000)] + [("", "x"), ("de", "w1é")]
    bits = divergence.kept_filter(spark.createDataFrame(rows, "lang string, term string"))
    for lang in ("en", "", "de"):
        assert divergence.may_be_kept(bits, lang, [t.encode() for g, t in rows if g == lang]).all()
    assert divergence.may_be_kept(bits, "en", [f"other{k}".encode() for k in range(3000)]).mean() < 0.01
    assert len(divergence.kept_filter(spark.createDataFrame([], "lang string, term string"))) == divergence.FILTER_WORDS
