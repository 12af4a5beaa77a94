"""The registered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import chunks, content_sort, divergence, host_rules, licences, mixing, pages, phrases, pieces, records, simhash, sketches, toxicity
from tallyhouse.session import ship_package

END_ID = 2

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def token_ids_digest(ids: str) -> F.Column:
    """Digest of decimal ids joined by commas."""
    return F.sha2(F.array_join(ids, ","), 256)


@query
def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.token_records(
        read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), END_ID
    )


@query
def op2_scaled_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.compare_with_next(read(spark, sf_dir, "documents"))


def with_paths(documents: DataFrame) -> DataFrame:
    """Documents as files of a tree: every tenth one is the licence file of a directory.

    Document 1234 of source s is ``d1/d12/d123/s/1234.txt``; 1230 is ``d1/d12/d123/LICENSE``, 1200 is
    ``d1/d12/LICENSE`` and 1000 is ``d1/LICENSE``.
    """
    i = F.col("doc_id")
    thousands, hundreds, tens = [F.concat(F.lit("d"), F.floor(i / k).cast("string")) for k in (1000, 100, 10)]
    return documents.withColumn(
        "path",
        F.when(i % 1000 == 0, F.concat_ws("/", thousands, F.lit("LICENSE")))
        .when(i % 100 == 0, F.concat_ws("/", thousands, hundreds, F.lit("LICENSE")))
        .when(i % 10 == 0, F.concat_ws("/", thousands, hundreds, tens, F.lit("LICENSE")))
        .otherwise(
            F.concat_ws("/", thousands, hundreds, tens, F.coalesce("source", F.lit("none")), F.concat(i.cast("string"), F.lit(".txt")))
        ),
    )


@query
def op3_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = with_paths(read(spark, sf_dir, "documents"))
    return licences.licence_of_files(files, "path", windows=True).select(
        "path", "licence", "origin", "score", "block", "licence_directory"
    )


@query
def op4_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = chunks.remove_repeated_chunks(read(spark, sf_dir, "documents"), run_words=chunks.RUN_WORDS)
    return cleaned.select(
        "doc_id",
        "removed_lines",
        F.length("text").cast("long").alias("kept_chars"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


@query
def op5_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = pieces.encode_pieces(documents, public_tokenizers.path("piece_bpe_32k.model"), drop=("text",))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        token_ids_digest("ids").alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(F.get("ends", F.size("ends") - 1), F.lit(0)).cast("long").alias("n_bytes"),
    )


@query
def op6_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.exact_groups(read(spark, sf_dir, "documents"))


ORACLES["op6_content_sort"] = r"""
WITH normal AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM normal WINDOW same AS (PARTITION BY body)
"""


@query
def op7_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(toxicity.labelled_sample(documents, read(spark, sf_dir, "labels")))
    return toxicity.score_toxicity(documents.select("doc_id", "text"), model, drop=("text",)).select(
        "doc_id", "expected_severity", "grade", F.col("rejected").alias("toxic")
    )


@query
def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read(spark, sf_dir, "documents"))


@query
def op9_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(read(spark, sf_dir, "documents"))


@query
def op10_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_main_text(read(spark, sf_dir, "pages"))


@query
def op13_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(read(spark, sf_dir, "documents")).select(
        "doc_id", *host_rules.MEASURES, "base_failed", "kept", "host_failed"
    )


ORACLES["op13_host_rules"] = r"""
WITH texts AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), words AS (
  SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM texts
), triples AS (
  SELECT doc_id, i, a, lead(a) OVER next AS b, lead(a, 2) OVER next AS c FROM words WINDOW next AS (PARTITION BY doc_id ORDER BY i)
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS times FROM triples WHERE c IS NOT NULL
), repeats AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM windows, range(3) AS r(k) WHERE times > 1 GROUP BY doc_id
), measures AS (
  SELECT t.doc_id, t.source, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM texts t LEFT JOIN repeats r ON t.doc_id = r.doc_id
), failures AS (
  SELECT *, n_words < 50 AS a, 100 * n_repeat_words > 50 * n_words AS b,
    n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 10 * n_words) AS c,
    10 * n_symbols > n_words AS d, 10 * n_dup_lines > 3 * n_lines AS e
  FROM measures
), hosts AS (
  SELECT source, count(*) AS docs, [count(*) FILTER (a), count(*) FILTER (b), count(*) FILTER (c),
    count(*) FILTER (d), count(*) FILTER (e)] AS failed
  FROM failures WHERE source IS NOT NULL GROUP BY source
), long AS (
  SELECT source, docs, unnest([1, 2, 3, 4, 5]) AS rule, unnest(failed) AS f FROM hosts
), prior AS (
  SELECT rule, avg(f / docs) AS m,
    var_pop(f / docs) - avg(f / docs) * (1 - avg(f / docs)) * avg(1 / docs) AS v
  FROM long GROUP BY rule
), failing AS (
  SELECT DISTINCT source FROM long JOIN prior USING (rule)
  WHERE CASE WHEN v > 0 THEN (f + greatest(m * (1 - m) / v - 1, 0) * m) / (docs + greatest(m * (1 - m) / v - 1, 0))
    ELSE m END > 0.5
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, a OR b AS base_failed,
  NOT (a OR b) AND h.source IS NULL AS kept, h.source IS NOT NULL AS host_failed
FROM failures f LEFT JOIN failing h ON f.source = h.source
"""


@query
def op11_phrase_stripes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


ORACLES["op11_phrase_stripes"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), numbered AS (
  SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), words AS (
  SELECT lang, id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM numbered
), threes AS (
  SELECT lang, a, lead(a) OVER next AS b, lead(a, 2) OVER next AS c FROM words WINDOW next AS (PARTITION BY id ORDER BY i)
), phrases AS (
  SELECT lang, phrase, n, count(*) AS f FROM (
    SELECT lang, a AS phrase, 1 AS n FROM threes
    UNION ALL SELECT lang, a || ' ' || b, 2 FROM threes WHERE b IS NOT NULL
    UNION ALL SELECT lang, a || ' ' || b || ' ' || c, 3 FROM threes WHERE c IS NOT NULL)
  GROUP BY ALL HAVING count(*) >= 10
), longer AS (
  SELECT lang, part, max(f) AS f FROM (
    SELECT lang, split_part(phrase, ' ', 1) || ' ' || split_part(phrase, ' ', 2) AS part, f FROM phrases WHERE n = 3
    UNION ALL SELECT lang, split_part(phrase, ' ', 2) || ' ' || split_part(phrase, ' ', 3), f FROM phrases WHERE n = 3)
  GROUP BY ALL
), kept AS (
  SELECT p.* FROM phrases p LEFT JOIN longer g ON p.lang = g.lang AND p.phrase = g.part AND p.n = 2
  WHERE p.n > 1 AND 100 * coalesce(g.f, 0) < 50 * p.f
), cuts AS (
  SELECT lang, phrase, f, k, array_to_string(string_split(phrase, ' ')[:k], ' ') AS first,
    array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest
  FROM kept, range(1, 3) AS r(k) WHERE k < n
), scored AS (
  SELECT c.lang, c.phrase, c.f AS a, l.f AS l, r.f AS r, k,
    (1000000::HUGEINT * c.f * c.f // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c JOIN phrases l ON c.lang = l.lang AND c.first = l.phrase JOIN phrases r ON c.lang = r.lang AND c.rest = r.phrase
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
  FROM lowest QUALIFY rank <= 2000
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN (SELECT lang, count(*) AS n FROM words GROUP BY lang) USING (lang)
"""


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(read(spark, sf_dir, "documents"))


ORACLES["op12_source_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), words AS (
  SELECT id, lang, source, translate(unnest(w), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs
), kept AS (
  SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT id) >= 10
), vocabulary AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY ALL
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), occurrences AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL
), sizes AS (
  SELECT lang, source, sum(n) AS n FROM occurrences GROUP BY ALL
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n,
    (1 + 1000000000::HUGEINT * (coalesce(o.n, 0) + 2) // (coalesce(s.n, 0) + 2 * v.v))::BIGINT AS p
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN vocabulary v ON g.lang = v.lang
  LEFT JOIN occurrences o ON g.lang = o.lang AND g.source = o.source AND k.term = o.term
  LEFT JOIN sizes s ON g.lang = s.lang AND g.source = s.source
), common AS (
  SELECT o.lang, o.term,
    (1 + 1000000000::HUGEINT * (sum(o.n) + 2) // (any_value(s.n) + 2 * any_value(v.v)))::BIGINT AS q
  FROM occurrences o JOIN (SELECT lang, sum(n) AS n FROM sizes GROUP BY ALL) s ON o.lang = s.lang
  JOIN vocabulary v ON o.lang = v.lang GROUP BY ALL
), gaps AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(g.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN gaps g ON a.lang = g.lang AND a.source = g.source AND b.source = g.item
), terms AS (
  SELECT s.lang, s.source, 'term' AS part, s.term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM shares s JOIN common c ON s.lang = c.lang AND s.term = c.term WHERE s.n > 0 AND p > q
)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM (FROM pairs UNION ALL FROM terms) QUALIFY part = 'pair' OR rank <= 10
"""
