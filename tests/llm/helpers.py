"""Small tables and plain reference computations for the tests of the llm operators."""

from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, ids=None, sources=None):
    """Documents with the given texts (None: missing), in several partitions."""
    ids = list(range(len(texts))) if ids is None else ids
    sources = [f"s{k % 3}" for k in range(len(texts))] if sources is None else sources
    rows = [(i, t, "en", s, len(t or "")) for i, t, s in zip(ids, texts, sources)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.repartition(3) if rows else df


def given(spark, table="documents"):
    return spark.read.parquet(f"{FOLDER}/{table}.parquet")


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def with_clashing_columns(df):
    """The frame with columns that have names operators use inside."""
    names = ("key", "fp", "digest", "part", "row", "src", "size", "block", "removed_lines", "ids", "path", "place")
    return df.select("*", *[F.lit("x").alias(n) for n in names])


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {n: root(n) for n in nodes}
