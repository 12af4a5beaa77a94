from collections import Counter

from pyspark.sql import functions as F
from tests.llm.helpers import documents, given, rows_of, with_clashing_columns

from tallyhouse.llm import host_rules

SPACE = " \t\n\x0b\x0c\r"


def words_by_hand(text):
    for c in SPACE:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def measures_by_hand(text):
    text = text or ""
    w = words_by_hand(text)
    windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    times = Counter(windows)
    covered = {k + j for k, x in enumerate(windows) if times[x] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if words_by_hand(x)]
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
    }


def failed_by_hand(m):
    n = m["n_words"]
    return [
        n < 50, 100 * m["n_repeat_words"] > 50 * n, n > 0 and not 3 * n <= m["word_chars"] <= 10 * n,
        10 * m["n_symbols"] > n, 10 * m["n_dup_lines"] > 3 * m["n_lines"],
    ]


def judged_by_hand(rows, limit):
    """(id, host, text) rows to sorted tuples, with every host's rates worked out in plain Python."""
    made = [(i, host, measures_by_hand(t)) for i, host, t in rows]
    hosts = sorted({h for _, h, _ in made if h is not None})
    bad = set()
    for rule in range(5):
        docs = {h: [failed_by_hand(m)[rule] for _, g, m in made if g == h] for h in hosts}
        rate = {h: sum(x) / len(x) for h, x in docs.items()}
        mean = sum(rate.values()) / max(1, len(rate))
        spread = sum((r - mean) ** 2 for r in rate.values()) / max(1, len(rate))
        spread -= mean * (1 - mean) * sum(1 / len(x) for x in docs.values()) / max(1, len(rate))
        for h, x in docs.items():
            k = max(mean * (1 - mean) / spread - 1, 0) if spread > 0 else None
            if (mean if k is None else (sum(x) + k * mean) / (len(x) + k)) > limit:
                bad.add(h)
    out = []
    for i, h, m in made:
        base = any(failed_by_hand(m)[:2])
        out.append((i, *[m[c] for c in host_rules.MEASURES], base, not base and h not in bad))
    return sorted(out, key=repr)


def found(df, limit=host_rules.HOST_LIMIT):
    rows = host_rules.judge(df, limit=limit).select("doc_id", *host_rules.MEASURES, "base_failed", "kept").collect()
    return sorted([tuple(r) for r in rows], key=repr)


def triples(df):
    return [(r.doc_id, r.source, r.text) for r in df.collect()]


def test_given_documents(spark):
    docs = given(spark)
    for limit in (host_rules.HOST_LIMIT, 0.08):
        assert found(docs.repartition(5), limit) == judged_by_hand(triples(docs), limit)


def test_odd_texts(spark):
    long = " ".join(f"w{k % 701}x{k % 13}" for k in range(30_000))
    texts = [
        None, "", " \n\t ", "one", "a b", "a a a a", "a b c a b c", "#*$ % && | <> éé\U0001f642", long, "x\n" * 500,
        "Line one.\n\nLine one.\n line one.\n \n \n", "    non breaking  ", "w" * 100_000, "a\x1cb c\x0bd\x0ce\rf",
    ]
    docs = with_clashing_columns(documents(spark, texts)).withColumn("host", F.lit("x")).withColumn("n_words", F.lit(-1))
    assert found(docs) == judged_by_hand(triples(docs), 0.5)
    assert found(documents(spark, [])) == []


def good(k):
    return " ".join(f"word{k}n{j}" for j in range(60))


def test_a_failing_host_takes_its_good_documents_along(spark):
    rows = [("bad", "# " * 30 + good(k)) for k in range(40)] + [("bad", good(99))] + [("fine", good(k)) for k in range(100, 140)]
    rows += [("small", "# " * 30 + good(200)), (None, good(300)), (None, good(300)), ("fine2", good(400))]
    df = documents(spark, [t for _, t in rows], sources=[h for h, _ in rows])
    kept = {}
    for r in host_rules.judge(df).collect():
        assert not r.base_failed and r.kept == (not r.host_failed)
        kept.setdefault(r.host, []).append(r.kept)
    assert not any(kept["bad"]) and all(kept["fine"]) and all(kept["fine2"]) and kept[None] == [True, True]
    assert found(df) == judged_by_hand(triples(df), 0.5)


def test_few_documents_of_a_host_say_little(spark):
    """One bad document of one: its rate goes to that of all hosts, unlike forty bad ones of forty."""
    rows = [(f"h{k}", good(100 * k + j)) for k in range(12) for j in range(30)]
    rows += [("worst", "# " * 30 + good(j)) for j in range(5000, 5040)] + [("single", "# " * 30 + good(7000))]
    rates = host_rules.host_rates(host_rules.measured(documents(spark, [t for _, t in rows], sources=[h for h, _ in rows])))
    symbols = {r.host: r.rate for r in rates.where("rule = 'symbols'").collect()}
    assert symbols["worst"] > 0.95 and 0 < symbols["h1"] < 0.05 and symbols["single"] < symbols["worst"]
    other = {r.rate for r in rates.where("rule = 'dup_lines'").collect()}
    assert other == {0.0}


def test_repeated_rows_and_ids_stay(spark):
    docs = documents(spark, [good(1), good(1), "x", None], ids=[5, 5, None, None], sources=["a", "a", None, None])
    assert found(docs) == judged_by_hand(triples(docs), 0.5)


def test_no_python_in_the_plan(spark):
    plan = host_rules.judge(given(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_rows_of_a_hot_host_are_split(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__advisoryPartitionSizeInBytes="4k",
         spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4k",
         spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
         spark__sql__adaptive__coalescePartitions__enabled="false")
    df = documents(spark, [good(k) for k in range(6000)], sources=["hot" if k % 3 else f"s{k % 97}" for k in range(6000)])
    judged = host_rules.judge(df.repartition(16), limit=-1.0)
    assert judged.where("NOT kept").count() == 6000
    assert rows_of(judged.limit(1))[0]["host_failed"]
    judged.collect()
    assert "skew=true" in judged._jdf.queryExecution().executedPlan().toString()
