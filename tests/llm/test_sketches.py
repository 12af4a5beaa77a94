import hashlib

import xxhash
from pyspark.sql import functions as F
from tests.llm.helpers import documents, given, rows_of, with_clashing_columns
from tests.llm.test_dedup import signed

from tallyhouse.llm import sketches


def sketch_by_hand(text):
    words = [w for w in text.replace("\n", " ").replace("\t", " ").split(" ") if w]
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    found = set()
    for k in range(max(1, len(hashes) - 4) if hashes else 0):
        seed = 42
        for h in hashes[k : k + 5]:
            seed = xxhash.xxh64_intdigest(h.to_bytes(8, "little"), seed)
        found.add(seed)
    kept = {h for h in found if h < 1 << (64 - sketches.FRACTION_BITS)}
    return kept or ({min(found)} if found else set())


def as_text(s):
    return "".join(f"{h:016x}" for h in sorted(s))


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def by_hand(rows):
    rows = sorted(rows)
    out = []
    for k, (i, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        give = len(text) // 4
        edited = text[: len(text) - give] + following[:give]
        a, b, c = sketch_by_hand(text), sketch_by_hand(edited), sketch_by_hand(following)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), as_text(a), as_text(b), likeness(a, b), likeness(a, c)))
    return out


def found(df):
    return sorted(tuple(r) for r in sketches.compare_with_next(df).collect())


def test_given_documents(spark):
    docs = given(spark)
    assert found(docs.repartition(4)) == by_hand([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_texts_over_many_ranges(spark, conf):
    conf(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="9", spark__sql__autoBroadcastJoinThreshold="-1")
    texts = [None, "", "éé🙂🙂 x", "one two three four five six", "w " * 300, "abc", "same text here", "same text here"]
    docs = with_clashing_columns(documents(spark, texts, ids=[9, 3, 40, 7, 100, 2, 55, 56]))
    assert found(docs) == by_hand([(r.doc_id, r.text) for r in docs.collect()])


def test_one_row_no_rows_and_repeats(spark):
    one = found(documents(spark, ["one two three four five six seven"]))
    assert one[0][6] == 1.0
    assert found(documents(spark, [])) == []
    twice = sketches.compare_with_next(documents(spark, ["a b", "a b", "c d"], ids=[1, 1, 2])).collect()
    assert len(twice) == 3 and len({tuple(r) for r in twice}) == 2
    missing = sketches.compare_with_next(documents(spark, ["a b", "c d"], ids=[None, None])).collect()
    assert len(missing) == 2


def test_merge_and_containment(spark):
    a, b = " ".join(f"a{k}" for k in range(400)), " ".join(f"b{k}" for k in range(30))
    df = spark.createDataFrame([(a, b, a + " " + b)], "a string, b string, ab string")
    s = df.select(*[sketches.sketch(F.col(c)).alias(c) for c in ("a", "b", "ab")])
    r = s.select(
        sketches.merge(F.col("a"), F.col("b")).alias("m"),
        sketches.containment(F.col("b"), F.col("ab")).alias("inside"),
        sketches.containment(F.col("ab"), F.col("b")).alias("outside"),
        "a", "b",
    ).first()
    assert {x & ((1 << 64) - 1) for x in r.m} >= sketch_by_hand(a)
    assert r.inside > 0.8 and r.outside < 0.2


def test_estimates_are_near_the_true_shares(spark):
    rows = by_hand([(r.doc_id, r.text) for r in given(spark).collect()])
    texts = [t for _, t in sorted((r.doc_id, r.text or "") for r in given(spark).collect())]

    def shingles(t):
        w = t.split()
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}

    errors = []
    for k, text in enumerate(texts):
        if len(text.split()) > 200:
            errors.append(abs(rows[k][6] - likeness(shingles(text), shingles(texts[(k + 1) % len(texts)]))))
    assert sum(errors) / len(errors) < 0.05
    assert rows_of(sketches.fingerprint(documents(spark, [None])))[0]["sketch"] == []
