import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F
from tests.llm.helpers import documents, given, with_clashing_columns

from tallyhouse.llm import phrases


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def by_hand(rows, least=phrases.LEAST, subsumed=50, top=2000):
    counts, sizes = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text or "")):
            w = [x for x in re.split("[ \t]", piece) if x]
            sizes[lang] += len(w)
            for n in (1, 2, 3):
                counts[lang].update(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
    out = []
    for lang, c in counts.items():
        longest = Counter()
        for p, a in c.items():
            if len(p) == 3 and a >= least:
                for part in (p[:2], p[1:]):
                    longest[part] = max(longest[part], a)
        found = []
        for p, a in c.items():
            if len(p) > 1 and a >= least and 100 * longest[p] < subsumed * a:
                score, k = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, sizes[lang], -s))
    return sorted(out)


def found(df, **options):
    return sorted(tuple(r) for r in phrases.collocations(df, **options).collect())


def pairs(df):
    return [(r.lang, r.text) for r in df.select("lang", "text").collect()]


def test_given_documents_over_many_small_stripes(spark, conf, monkeypatch):
    docs = given(spark).withColumn("lang", F.when(F.col("doc_id") % 7 > 0, F.col("lang")))
    expected = by_hand(pairs(docs))
    assert len(expected) > 50
    assert found(docs) == expected
    conf(spark__sql__shuffle__partitions="7", spark__sql__execution__arrow__maxRecordsPerBatch="50",
         spark__sql__autoBroadcastJoinThreshold="-1")
    assert found(docs.repartition(5)) == expected
    assert found(docs.repartition(3), top=20) == by_hand(pairs(docs), top=20)


def test_odd_texts(spark):
    texts = [
        None, "", " \t ", "...", "one", "New York, new york\nNEW  YORK\tnew york." * 5, "a b c " * 30, "É é É é É é" * 9,
        "x\x00y x\x00y\x1cz " * 12, "word" * 50_000 + " end", "same same same same " * 20, "İstanbul ΑΒΓ αβγ;" * 11,
    ]
    docs = with_clashing_columns(documents(spark, texts)).withColumn("phrase", F.lit("x")).withColumn("prefix", F.lit(1))
    for least in (1, 10):
        assert found(docs, least=least) == by_hand(pairs(docs), least=least)
    assert found(documents(spark, [])) == [] and found(documents(spark, [None, None])) == []


def test_long_texts_are_cut_at_piece_ends_only(spark, monkeypatch):
    text = ("alpha beta gamma. delta alpha beta, " * 400).encode()
    monkeypatch.setattr(phrases, "FLUSH_BYTES", 100)
    parts = list(phrases._parts(text))
    assert len(parts) > 50 and b"".join(parts) == text.translate(phrases.TRANSLATION)
    assert list(phrases._parts(b"no end " * 100)) == [b"no end " * 100]


def test_stripes_add_up_whatever_their_size(monkeypatch):
    """Many small stripes of one prefix, over the doubling of an open one, give what one large one does."""
    import numpy as np
    import pyarrow as pa

    total, last = Counter(), phrases._Open(("en", "p", 0))
    rng = np.random.default_rng(5)
    for _ in range(40):
        words = [f"w{k}" for k in rng.integers(0, 30_000, 20_000)]
        total.update(words)
        last.add(pa.array(words), np.ones(len(words), np.int64))
    following, counts = last.close()
    assert dict(zip(following.to_pylist(), counts.tolist())) == dict(total)


def test_ties_go_to_the_smaller_cut_and_the_smaller_phrase(spark):
    docs = documents(spark, ["b c. a b. d e f. " * 10])
    assert [(r[2], r[7]) for r in sorted(found(docs), key=lambda r: r[1])] == [("d e f", 1_000_000), ("a b", 500_000), ("b c", 500_000)]
    assert found(docs) == by_hand(pairs(docs))


def test_scores_beyond_64_bits_are_exact(spark, monkeypatch):
    """Counts of four milliards: products pass 64 bits."""
    big = 4_000_000_007
    rows = [("en", "x", 1, 3 * big, 0), ("en", "y", 1, 2 * big + 1, 0), ("en", "x y", 2, 2 * big - 5, 0), ("en", "", 0, 9 * big, 0)]
    monkeypatch.setattr(phrases, "merged", lambda made, least: spark.createDataFrame(rows, phrases.PHRASES))
    a, left, right = 2 * big - 5, 3 * big, 2 * big + 1
    assert found(documents(spark, ["x"])) == [("en", 1, "x y", a, left, right, 9 * big, 1_000_000 * a * a // (left * right))]
