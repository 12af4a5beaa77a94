"""Exact duplicates by sorting content."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import SPACES, text_of
from tallyhouse.sources.staging import stage

# Characters of the text that splitters are sampled over; ties are split by a digest and the id.
SPLITTER_CHARS = 48

ROWS_SCHEMA = (
    "doc_id long, text_sha256 string, part long, run long, edge boolean, edge_text string"
)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the runs of equal texts in a sorted range, comparing each row with the one before it.

    The first row of a run gives its text where the run may go on in another range: where its leading
    characters and digest are those of the first or the last row of this range. Whether a run is at the
    end is known one key later, so the rows of the last key are held back as ids only.
    """
    names = [x.split()[0] for x in ROWS_SCHEMA.split(", ")]
    part = TaskContext.get().partitionId()
    run, last_key, last_text, first_key = -1, None, None, None
    held: list[tuple] = []  # rows of the latest key: id, digest, run; texts of its runs by number
    texts: dict[int, str] = {}

    def rows(edge: bool) -> pa.RecordBatch:
        seen: set[int] = set()
        edge_texts = []
        for _, _, r in held:
            edge_texts.append(texts[r] if edge and r not in seen else None)
            seen.add(r)
        ids, digests, runs = zip(*held)
        n = len(held)
        arrays = [pa.array(ids, pa.int64()), pa.array(digests, pa.string()), pa.array([part] * n, pa.int64()),
                  pa.array(runs, pa.int64()), pa.array([edge] * n), pa.array(edge_texts, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, names)

    for batch in batches:
        text = batch.column("text")
        lead, digest = batch.column("lead").to_pylist(), batch.column("digest").to_pylist()
        ids, shas = batch.column("doc_id").to_pylist(), batch.column("text_sha256").to_pylist()
        n = batch.num_rows
        if not n:
            continue
        changed = np.ones(n, bool)
        changed[1:] = ~pc.equal(text.slice(1), text.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        changed[0] = last_text is None or text[0].as_py() != last_text
        for k in range(n):
            key = (lead[k], digest[k])
            if key != last_key:
                if held:
                    yield rows(last_key == first_key)
                held, texts = [], {}
                first_key = key if last_key is None else first_key
                last_key = key
            if changed[k]:
                run += 1
            if run not in texts:
                texts[run] = text[k].as_py()
            held.append((ids[k], shas[k], run))
        last_text = text[n - 1].as_py()
    if held:
        yield rows(True)


def exact_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are identical once every run of white space is one space; missing texts
    are empty. Splitters sampled over (leading characters, digest, id) deal the rows to ranges, so that
    a text with very many copies is spread over ranges by its ids; each range is sorted externally and
    neighbours are compared in full. Runs inside a range are whole. Runs at the edges of ranges are put
    together by their full texts, one row per range and run.

    The row with the smallest ``doc_id`` of its group is kept; a missing id sorts first. Rows that repeat
    an id within a group are all marked ``kept`` with it, as nothing tells them apart. An empty table
    gives no rows; other columns are not read.
    """
    norm = F.regexp_replace(text_of(f"`{text}`"), SPACES, " ")
    keyed = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), norm.alias("text")).select(
        "doc_id", "text", F.substring("text", 1, SPLITTER_CHARS).alias("lead"), F.xxhash64("text").alias("digest")
    )
    ordered = keyed.repartitionByRange("lead", "digest", F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        "lead", "digest", "text", F.col("doc_id").asc_nulls_first()
    )
    hashed = ordered.select("doc_id", "text", "lead", "digest", F.sha2("text", 256).alias("text_sha256"))
    rows = stage(hashed.mapInArrow(_runs, ROWS_SCHEMA), "content-sort")

    # A missing id is smaller than any other.
    least = F.when(F.count("doc_id") == F.count(F.lit(1)), F.min("doc_id"))
    runs = rows.groupBy("part", "run").agg(
        least.alias("least"), F.count(F.lit(1)).alias("size"), F.max("edge").alias("edge"), F.max("edge_text").alias("edge_text")
    )
    edges = runs.where("edge").groupBy("edge_text").agg(
        F.when(F.count("least") == F.count(F.lit(1)), F.min("least")).alias("group_least"), F.sum("size").alias("group_size")
    )
    whole = runs.where("NOT edge").select("part", "run", F.col("least").alias("keep_id"), F.col("size").alias("group_size"))
    joined = runs.where("edge").join(stage(edges, "edge-runs"), "edge_text")
    groups = whole.unionByName(joined.select("part", "run", F.col("group_least").alias("keep_id"), "group_size"))
    return rows.join(groups, ["part", "run"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
