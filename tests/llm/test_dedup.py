"""Exact copies, near copies and repeated passages against plain computations."""

import hashlib
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F
from tests.llm.helpers import components, documents, given, rows_of, with_clashing_columns

from tallyhouse.llm import chunks, content_sort, simhash
from tallyhouse.llm.components import connected_components


# --- exact ---------------------------------------------------------------------------------------
def exact_by_hand(rows):
    normal = pd.DataFrame([(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows], columns=["i", "t"])
    out = []
    for text, group in normal.groupby("t"):
        for i in group.i:
            out.append((int(i), int(group.i.min()), len(group), i == group.i.min(), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


def exact(df):
    return sorted((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in content_sort.exact_groups(df).collect())


def test_exact_copies_of_the_given_documents(spark):
    docs = given(spark)
    assert exact(docs) == exact_by_hand([(r.doc_id, r.text) for r in docs.collect()])


def test_exact_copies_that_span_many_ranges(spark, conf):
    conf(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="13")
    head = "h" * 60
    texts = ["same  text"] * 150 + ["same\ttext", None, "", head + "1", head + "2", head + "1 "] + [f"t{k % 40}" for k in range(90)]
    docs = with_clashing_columns(documents(spark, texts, ids=[(k * 37) % len(texts) for k in range(len(texts))]))
    found = content_sort.exact_groups(docs)
    assert exact(docs) == exact_by_hand([(r.doc_id, r.text) for r in docs.collect()])
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_exact_copies_without_rows_or_ids(spark):
    assert exact(documents(spark, [])) == []
    found = content_sort.exact_groups(documents(spark, ["a", "a", "b", "b"], ids=[None, 2, 5, 5])).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in found} == {(None, None, True), (2, None, False), (5, 5, True)}


# --- near ----------------------------------------------------------------------------------------
def fingerprint_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_by_hand(rows):
    prints = {i: fingerprint_by_hand(t) for i, t in rows}
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    links = []
    for k in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(values[k] ^ values[k + 1 :]) <= 3):
            links.append((ids[k], ids[k + 1 + j]))
    roots = components(ids, links)
    return sorted((i, f"{prints[i]:016x}", roots[i]) for i in ids)


def near(df):
    return sorted((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_groups(df).collect())


def test_near_copies_of_the_given_documents(spark):
    docs = given(spark)
    assert near(docs) == near_by_hand([(r.doc_id, r.text) for r in docs.collect()])


def test_near_copies_of_odd_texts(spark):
    texts = [None, "", " \n", "one", "ONE", "one two", "Ébène x y", "ébène x y", "a b c d", "a b c d"] + [
        f"{'w ' * 40}{k}" for k in range(20)
    ]
    docs = with_clashing_columns(documents(spark, texts))
    assert near(docs) == near_by_hand([(r.doc_id, r.text) for r in docs.collect()])
    assert near(documents(spark, [])) == []
    assert [r[2] for r in near(documents(spark, ["x y z", "x y z", "x y z"], ids=[4, 4, 2]))] == [2, 2, 2]


def test_first_rows_of_near_groups_stay_also_without_ids(spark):
    texts = ["a b c d", "a b c d", "other words here", "once more others", None, "", "a b c d", "e f g h", "i j k l"]
    docs = with_clashing_columns(documents(spark, texts, ids=[3, 1, None, None, 8, None, None, 5, 5]))
    kept = simhash.keep_first_of_groups(docs)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert found == sorted([
        (1, "a b c d"), (None, "other words here"), (None, "once more others"), (8, None), (5, "e f g h"), (5, "i j k l"),
    ], key=repr)
    assert simhash.keep_first_of_groups(documents(spark, [])).count() == 0


def test_long_text_is_voted_in_slices(monkeypatch):
    text = " ".join(f"w{k % 97}" for k in range(1000))
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 64)
    assert simhash.fingerprint(text) == fingerprint_by_hand(text)


def clustered(seed, n, shared=None):
    rng = random.Random(seed)
    values = set()
    while len(values) < n:
        v = rng.getrandbits(64)
        if shared is not None:
            v = v & ~0xFFFF | shared
        for _ in range(rng.choice([1, 1, 3, 12])):
            values.add(v)
            for _ in range(rng.randint(0, 4)):
                v ^= 1 << rng.randrange(64)
    return sorted(values)[:n]


def groups_of(spark, values):
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long").repartition(4)
    roots = {r.node: r.root for r in connected_components(simhash.fingerprint_links(df)).collect()}
    by = {}
    for v in values:
        s = v - (1 << 64) if v >> 63 else v
        by.setdefault(roots.get(s, s), set()).add(v)
    return {frozenset(g) for g in by.values()}


def groups_by_hand(values):
    array = np.array(values, np.uint64)
    links = [(k, k + 1 + int(j)) for k in range(len(values)) for j in np.flatnonzero(np.bitwise_count(array[k] ^ array[k + 1 :]) <= 3)]
    by = {}
    for k, r in components(range(len(values)), links).items():
        by.setdefault(r, set()).add(values[k])
    return {frozenset(g) for g in by.values()}


def test_links_join_all_near_fingerprints(spark):
    values = clustered(1, 1500)
    assert groups_of(spark, values) == groups_by_hand(values)


def test_links_of_a_part_that_very_many_share(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 64)
    monkeypatch.setattr(simhash, "TILE", 16)
    values = clustered(2, 900, shared=0x1234)
    assert groups_of(spark, values) == groups_by_hand(values)


def test_tiles_of_the_given_documents_are_compared_or_skipped(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    prints = {fingerprint_by_hand(r.text) for r in given(spark).collect()}
    prints = sorted(prints | {x ^ (5 << k % 60) for k, x in enumerate(sorted(prints)[:40])})
    values = np.array(prints, np.uint64)
    counts = np.sort(np.bitwise_count(values).astype(np.int64))
    pairs = set(simhash.tile_pairs(counts))
    starts = range(0, len(values), 16)
    for a in starts:
        for b in starts[a // 16 :]:
            within = (counts[b : b + 16, None] - counts[None, a : a + 16]).min() <= 3
            assert ((a, b) in pairs) == within
    assert len(starts) < len(pairs) < len(starts) * (len(starts) + 1) // 2
    seen = []
    whole = simhash.tile_pairs
    monkeypatch.setattr(simhash, "tile_pairs", lambda c: (seen.append(p) or p for p in whole(c)))
    found = {frozenset((prints[x], prints[y])) for x, y in simhash.tile_links(values)}
    assert set(seen) == pairs and len(found) > 30
    links = [(x, y) for x in prints for y in prints if x < y and (x ^ y).bit_count() <= 3]
    assert components(prints, [tuple(f) for f in found]) == components(prints, links)


def test_every_cell_goes_through_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "ROWS", 50)
    monkeypatch.setattr(simhash, "TILE", 16)
    values = clustered(4, 600)
    batches = []
    cells = sorted((v >> (16 * k) & 0xFFFF | k << 16, v) for v in values for k in range(4))
    for at in range(0, len(cells), 37):
        part = cells[at : at + 37]
        batches.append(pa.RecordBatch.from_pydict({
            "cell": pa.array([c for c, _ in part], pa.int64()),
            "fp": pa.array(np.array([v for _, v in part], np.uint64).view(np.int64)),
            "side": pa.array([0] * len(part), pa.int32()),
        }))
    found = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for out in simhash._cell_links(iter(batches)) for r in out.to_pylist()]
    links = [(x, y) for x in values for y in values if x < y and (x ^ y).bit_count() <= 3]
    assert len(found) < 4 * len(links)  # forests: they join the same fingerprints, not all by direct links
    assert components(values, found) == components(values, links)


def test_components_of_chains_stars_and_loops(spark):
    links = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200), (200, 201)]
    df = spark.createDataFrame(links, "a long, b long")
    nodes = {x for p in links for x in p if p[0] != p[1]}
    assert {r.node: r.root for r in connected_components(df).collect() if r.node != r.root} == {
        n: r for n, r in components(nodes, links).items() if n != r
    }
    assert connected_components(df.limit(0)).count() == 0


# --- repeated chunks -----------------------------------------------------------------------------
def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chunks_by_hand(text):
    lines = text.split("\n")
    h = [signed(xxhash.xxh64_intdigest(x.encode(), 42)) for x in lines]

    def chained(values):
        seed = 42
        for v in values:
            seed = xxhash.xxh64_intdigest(int(v).to_bytes(8, "little", signed=True), seed)
        return signed(seed)

    r = [chained(h[max(0, k - 1) : k + 1]) for k in range(len(h))]
    cuts = [0] + [k + 1 for k in range(1, len(h) - 1) if r[k] < r[k - 1] and r[k] < r[k + 1]] + [len(lines)]
    return [lines[a:b] for a, b in zip(cuts, cuts[1:])]


def dedup_by_hand(rows):
    seen, out = set(), []
    for i, text in sorted(rows):
        kept, gone = [], 0
        for c in chunks_by_hand(text or ""):
            body = "\n".join(c)
            if len(c) > 1 and body in seen:
                gone += len(c)
            else:
                kept.append(body)
                if len(c) > 1:
                    seen.add(body)
        out.append((i, "\n".join(kept) if gone else text, gone))
    return out


def deduped(df):
    return sorted((r.doc_id, r.text, r.removed_lines) for r in chunks.remove_repeated_chunks(df).collect())


def passages(seed=3):
    rng = random.Random(seed)
    line = lambda: " ".join(rng.choice("ab cd ef gh ij kl".split()) + str(rng.randrange(999)) for _ in range(6))
    shared = [[line() for _ in range(rng.randint(6, 14))] for _ in range(4)]
    texts = []
    for _ in range(60):
        body = [line() for _ in range(rng.randint(0, 8))]
        if rng.random() < 0.6:
            at = rng.randint(0, len(body))
            body[at:at] = rng.choice(shared)
        texts.append("\n".join(body))
    return texts, shared


def test_chunks_tile_the_text_and_follow_the_rule(spark):
    texts, _ = passages()
    texts += ["", "\n", "a\n\n\nb", "x\n" * 50, "one line"]
    df = documents(spark, texts).select("text", chunks.line_chunks(F.col("text")).alias("c"))
    for r in df.collect():
        assert [c.body.split("\n") for c in r.c] == chunks_by_hand(r.text)
        assert "\n".join(c.body for c in r.c) == r.text and [c.no for c in r.c] == list(range(1, len(r.c) + 1))
        assert all(c.lines > 1 for c in r.c[:-1])


def test_repeated_chunks_of_generated_passages(spark):
    texts, shared = passages()
    docs = documents(spark, texts)
    found = deduped(docs)
    assert found == dedup_by_hand(list(enumerate(texts)))
    assert sum(r[2] for r in found) > 40


def test_repeated_chunks_of_the_given_documents(spark):
    docs = given(spark)
    assert deduped(docs) == dedup_by_hand([(r.doc_id, r.text) for r in docs.collect()])


def test_repeated_chunks_of_odd_rows(spark):
    text = "\n".join(f"line {k}" for k in range(12))
    docs = with_clashing_columns(documents(spark, [None, "", text, text, "x\n" + text], ids=[0, 1, 2, 3, 4]))
    found = deduped(docs)
    assert found[:3] == [(0, None, 0), (1, "", 0), (2, text, 0)] and found[3][2] >= 10
    assert set(chunks.remove_repeated_chunks(docs).columns) == set(docs.columns)
    assert deduped(documents(spark, [])) == []
    # Rows equal in everything are one document; another text under the same id is not.
    twice = deduped(documents(spark, [text, text, "y\n" + text], ids=[5, 5, 5], sources=["s", "s", "s"]))
    assert sorted(r[2] for r in twice)[0] == 0 and sum(r[2] == 0 for r in twice) in (1, 2)


def runs_by_hand(lines, words):
    """Starts and ends of all runs of lines that have so many words and cannot lose a line."""
    weights = [max(1, len(x.split())) for x in lines]
    out = set()
    for a in range(len(lines)):
        for b in range(a + 1, min(len(lines), a + words) + 1):
            n = sum(weights[a:b])
            if n >= words and (n - weights[a] < words or n - weights[b - 1] < words):
                out.add((a, b))
    return out


def dedup_with_runs_by_hand(rows, words):
    first, spans = {}, {}
    for i, text in sorted(rows):
        lines, at, here = text.split("\n"), 0, runs_by_hand(text.split("\n"), words)
        for c in chunks_by_hand(text):
            here |= {(at, at + len(c))} if len(c) > 1 else set()
            at += len(c)
        spans[i] = here
        for a, b in sorted(here):
            first.setdefault("\n".join(lines[a:b]), (i, a, b))
    out = []
    for i, text in sorted(rows):
        lines, gone = text.split("\n"), set()
        for a, b in spans[i]:
            j, _, end = first["\n".join(lines[a:b])]
            if j < i or end <= a:
                gone |= set(range(a, b))
        out.append((i, "\n".join(x for k, x in enumerate(lines) if k not in gone) if gone else text, len(gone)))
    return out


def deduped_with_runs(df, words=chunks.RUN_WORDS):
    return sorted((r.doc_id, r.text, r.removed_lines) for r in chunks.remove_repeated_chunks(df, run_words=words).collect())


def test_repeated_passages_of_few_long_lines_go_between_other_neighbours(spark):
    rng = random.Random(5)
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    texts = []
    for m, n in [(1, 50), (2, 30), (3, 20), (8, 7)]:
        passage = [line(n) for _ in range(m)]
        texts += ["\n".join([line(9), *passage, line(9), line(9)]) for _ in range(3)]
        texts.append("\n".join(passage))
    found = deduped_with_runs(documents(spark, texts))
    assert [r[2] for r in found] == [x for m in (1, 2, 3, 8) for x in (0, m, m, m)]
    assert found == dedup_with_runs_by_hand(list(enumerate(texts)), chunks.RUN_WORDS)
    short = "\n".join(["a b c"] * 3)
    assert [r[2] for r in deduped_with_runs(documents(spark, [f"x\n{short}\ny", f"z\n{line(49)}\nq", None, ""]))] == [0] * 4


def test_runs_of_generated_and_given_documents_and_of_equal_lines(spark):
    texts, _ = passages()
    assert deduped_with_runs(documents(spark, texts), 20) == dedup_with_runs_by_hand(list(enumerate(texts)), 20)
    texts = ["x\n" * 300, "a\n" + "x\n" * 120, "\n".join(["one two three"] * 40)]
    assert deduped_with_runs(documents(spark, texts)) == dedup_with_runs_by_hand(list(enumerate(texts)), chunks.RUN_WORDS)
    rows = [(r.doc_id, r.text) for r in given(spark).collect()]
    by_runs, plain = deduped_with_runs(given(spark)), dedup_by_hand(rows)
    assert by_runs == dedup_with_runs_by_hand(rows, chunks.RUN_WORDS)
    assert all(a[2] >= b[2] for a, b in zip(by_runs, plain)) and sum(a[2] for a in by_runs) > sum(b[2] for b in plain)
