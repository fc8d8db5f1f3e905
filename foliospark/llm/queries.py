"""One registered query per operator: the operator over its whole table, digested to columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm import toxicity
from foliospark.llm.decontam import find_leaks
from foliospark.llm.impact import rank
from foliospark.llm.jaccard import link_similar
from foliospark.llm.langid import fit, identify
from foliospark.llm.licenses import scan_licenses
from foliospark.llm.linededup import dedup_lines
from foliospark.llm.merkle import manifest
from foliospark.llm.packing import pack
from foliospark.llm.quality import rate_quality
from foliospark.llm.rabitq import nearest
from foliospark.llm.sharding import shard
from foliospark.llm.tables import sized
from foliospark.llm.tokencount import with_token_counts
from foliospark.queries.registry import Query, Run

LLM: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(run: Run) -> Run:
        LLM[name] = Query(run, sql)
        return run

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


_LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_EDGES_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINES_SQL = f"""
WITH split AS (
    SELECT row_number() OVER () AS rid, doc_id,
           string_split(coalesce(text, ''), chr(10)) AS lines
    FROM documents),
placed AS (
    SELECT rid, doc_id, i, lines[i] AS line,
           trim({_LOWER_SQL.format('lines[i]')}, {_EDGES_SQL}) AS line_key
    FROM (SELECT *, unnest(generate_series(1, len(lines))) AS i FROM split)),
common AS (
    SELECT line_key FROM placed WHERE line_key <> ''
    GROUP BY line_key HAVING count(DISTINCT rid) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE c.line_key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i)
                       FILTER (WHERE c.line_key IS NULL), '')) AS kept_sha256
FROM placed LEFT JOIN common c USING (line_key)
GROUP BY rid, doc_id
"""


@query("op4_line_dedup", LINES_SQL)
def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = dedup_lines(documents(spark, folder).select("doc_id", "text"), min_docs=10)
    return kept.select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("kept_text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


QUALITY_SQL = r"""
WITH split AS (
    SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                       lambda w: w <> '') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS l
    FROM documents),
windows AS (
    SELECT rid, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4] AS g
    FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 4)) AS i FROM split)),
twice AS (
    SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, g) AS n FROM windows)
    WHERE n >= 2),
covered AS (
    SELECT rid, count(DISTINCT i + j) AS n
    FROM (SELECT rid, i, unnest([0, 1, 2, 3, 4]) AS j FROM twice) GROUP BY rid),
counted AS (
    SELECT s.rid, doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
           CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(l) AS BIGINT) AS n_lines,
           CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
           coalesce(c.n, 0) AS n_repeat_words
    FROM split s LEFT JOIN covered c ON c.rid = s.rid),
ruled AS (
    SELECT *, n_words < 10 AS f1, 100 * n_repeat_words > 20 * n_words AS f2,
           n_symbols > 2.0 * n_words AS f3, n_dup_lines > 0.5 * n_lines AS f4,
           n_words > 0 AND NOT (word_chars BETWEEN 1.5 * n_words AND 25.0 * n_words) AS f5
    FROM counted),
hosts AS (
    SELECT source, count(*) AS n, r AS rule, sum(CAST(f AS INT)) AS k
    FROM (SELECT source, unnest([1, 2, 3, 4, 5]) AS r, unnest([f1, f2, f3, f4, f5]) AS f FROM ruled)
    GROUP BY source, r),
prior AS (
    SELECT rule, avg(1.0 / n) AS inv, avg(k / n) AS m, var_pop(k / n) AS v
    FROM hosts GROUP BY rule),
weighted AS (
    SELECT rule, m, CASE WHEN v - m * (1 - m) * inv > 0 AND m * (1 - m) > v - m * (1 - m) * inv
                         THEN m * (1 - m) / (v - m * (1 - m) * inv) - 1 ELSE 100 END AS s
    FROM prior),
verdicts AS (
    SELECT source, max((k + m * s) / (n + s)) <= 0.5 AS passed
    FROM hosts JOIN weighted USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       f1 OR f2 AS base_failed, NOT (f1 OR f2) AND passed AS kept
FROM ruled JOIN verdicts v ON v.source IS NOT DISTINCT FROM ruled.source
"""


@query("op6_quality_rules", QUALITY_SQL)
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rate_quality(documents(spark, folder)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


JACCARD_SQL = rf"""
WITH RECURSIVE split AS (
    SELECT row_number() OVER () AS rid, doc_id,
           list_filter(string_split_regex({_LOWER_SQL.format("coalesce(text, '')")},
                                          '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents),
sets AS MATERIALIZED (
    SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3]
                            for i in generate_series(1, len(w) - 3)]) END AS s
    FROM split),
grams AS MATERIALIZED (SELECT rid, unnest(s) AS g FROM sets),
shared AS (
    SELECT a.rid AS a, b.rid AS b, count(*) AS nb FROM grams a JOIN grams b USING (g)
    WHERE a.rid < b.rid GROUP BY a.rid, b.rid),
links AS MATERIALIZED (
    SELECT a, b FROM shared o JOIN sets x ON x.rid = a JOIN sets y ON y.rid = b
    WHERE 100 * nb >= 85 * (len(x.s) + len(y.s) - nb)),
edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
    SELECT rid AS origin, rid AS node FROM sets
    UNION SELECT origin, b FROM reach JOIN edges ON a = node)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(o.doc_id) AS component_id
FROM reach JOIN sets s ON s.rid = origin JOIN sets o ON o.rid = node
GROUP BY s.rid, s.doc_id, s.s
"""


@query("op9_ngram_jaccard", JACCARD_SQL)
def ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    found = link_similar(documents(spark, folder).select("doc_id", "text"), size=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


@query("op10_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = find_leaks(documents(spark, folder).select("doc_id", "text"), benchmark)
    return found.select("doc_id", "item_id", "n_agree", "n_span", "at_word")


def held_out() -> Column:
    """Rows that no model may learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


@query("op3_language_id")
def language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = fit(docs.where(~held_out()))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "languages"
    )


@query("op5_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return pack(documents(spark, folder).select("doc_id", "text"), tokenizer)


@query("op7_token_counts")
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return with_token_counts(docs, tokenizer).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op8_best_fit_sharding")
def best_fit_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard(documents(spark, folder).select("doc_id", "text")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op1_license_scan")
def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(documents(spark, folder).select("doc_id", "text")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


@query("op2_toxicity")
def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs.where(~held_out()).join(sized(labels), "doc_id"))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted"
    )


_FIELD_SQL = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    fields = ("doc_id", "source", "lang", "n_chars", text)
    return "sha256(" + " || ".join(_FIELD_SQL.format(f) for f in fields) + ")"


# crc32 of the decimal key, byte by byte and bit by bit
_CRC_SQL = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''),
    lambda c: ascii(c)::BIGINT)), lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, step: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT)"""

MERKLE_SQL = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
    SELECT *, row_number() OVER tree - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM (
        SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || source, '') AS grp,
               {_leaf_sql("text")} AS leaf,
               CASE WHEN {_CRC_SQL} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")}
                    ELSE {_leaf_sql("text")} END AS amended
        FROM documents)
    WINDOW tree AS (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf, amended)),
trees AS (
    SELECT 0 AS level, grp, pos, leaf AS digest, n FROM leaves
    UNION ALL
    SELECT any_value(level) + 1, grp, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), any_value(n + 2) // 3
    FROM trees WHERE n > 1 GROUP BY grp, pos // 3),
nodes AS MATERIALIZED (SELECT * FROM trees),
subroots AS MATERIALIZED (
    SELECT grp, digest, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n
    FROM nodes WHERE n = 1),
last AS (
    SELECT 0 AS level, pos, digest, n FROM subroots
    UNION ALL
    SELECT any_value(level) + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), any_value(n + 2) // 3
    FROM last WHERE n > 1 GROUP BY pos // 3),
tops AS MATERIALIZED (SELECT * FROM last),
heights AS (SELECT grp, max(level) AS h FROM nodes GROUP BY grp),
steps AS (
    SELECT rid, x.level,
           string_agg(y.digest, '' ORDER BY y.pos) FILTER (WHERE y.pos < x.pos) AS l,
           string_agg(y.digest, '' ORDER BY y.pos) FILTER (WHERE y.pos > x.pos) AS r
    FROM leaves JOIN heights USING (grp) JOIN nodes x ON x.grp = leaves.grp AND x.level < h
         AND x.pos = leaves.pos // CAST(power(3, x.level) AS BIGINT)
    JOIN nodes y ON y.grp = x.grp AND y.level = x.level AND y.pos // 3 = x.pos // 3
    GROUP BY ALL
    UNION ALL
    SELECT rid, h + x.level,
           string_agg(y.digest, '' ORDER BY y.pos) FILTER (WHERE y.pos < x.pos),
           string_agg(y.digest, '' ORDER BY y.pos) FILTER (WHERE y.pos > x.pos)
    FROM leaves JOIN heights USING (grp) JOIN subroots s USING (grp)
    JOIN tops x ON x.n > 1 AND x.pos = s.pos // CAST(power(3, x.level) AS BIGINT)
    JOIN tops y ON y.level = x.level AND y.pos // 3 = x.pos // 3
    GROUP BY rid, h, x.level, x.pos),
ways AS (
    SELECT rid, list({{'l': coalesce(l, ''), 'r': coalesce(r, '')}} ORDER BY level) AS way FROM steps GROUP BY rid),
folds AS (
    SELECT rid, 1 AS i, amended AS digest FROM leaves
    UNION ALL
    SELECT f.rid, i + 1, sha256(way[i].l || digest || way[i].r) FROM folds f JOIN ways USING (rid) WHERE i <= len(way)),
folded AS (SELECT rid, arg_max(digest, i) AS folded_root FROM folds GROUP BY rid)
SELECT doc_id, leaf, s.digest AS subroot, t.digest AS root,
       sha256(coalesce(array_to_string(list_transform(way, lambda w: w.l || w.r), ''), '')) AS proof_sha256,
       folded_root, folded_root = t.digest AS verified
FROM leaves JOIN subroots s USING (grp) JOIN tops t ON t.n = 1 JOIN folded USING (rid) LEFT JOIN ways USING (rid)
"""


@query("op11_merkle_manifest", MERKLE_SQL)
def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "source", "lang", "n_chars", "text")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    amended = {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    return manifest(docs, amended, tampered).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


_TERMS_SQL = (
    "regexp_extract_all(" + _LOWER_SQL.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

RANKED_SQL = f"""
WITH words AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {_TERMS_SQL} AS w FROM documents),
totals AS (SELECT count(*) FILTER (len(w) > 0) AS nd, CAST(sum(len(w)) AS BIGINT) AS nt FROM words),
counts AS MATERIALIZED (
    SELECT rid, doc_id, term, n, count(*) AS tf
    FROM (SELECT rid, doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM words) GROUP BY ALL),
weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counts, totals GROUP BY term, nd),
asked AS (
    SELECT irow, item_id, term, count(*) AS c FROM (
        SELECT row_number() OVER () AS irow, item_id, unnest({_TERMS_SQL}) AS term FROM benchmark) GROUP BY ALL),
scored AS (
    SELECT irow, item_id, rid, doc_id,
           CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * nd) // nt)))) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN counts USING (term), totals GROUP BY ALL),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY irow ORDER BY score DESC, doc_id NULLS LAST) AS place
    FROM scored WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10
"""


@query("op13_ranked_search", RANKED_SQL)
def ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text")
    return rank(documents(spark, folder).select("doc_id", "text"), benchmark, k=10)


NEAREST_SQL = """
WITH usable AS MATERIALIZED (
    SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
measured AS (
    SELECT q.vec_id AS query_id, c.vec_id, q.v,
           sqrt(list_reduce(list_transform(list_zip(q.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])),
                            lambda s, x: s + x)) AS score
    FROM usable q JOIN usable c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id, v ORDER BY score, vec_id) AS place FROM measured)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10
"""


@query("op12_one_bit_neighbours", NEAREST_SQL)
def one_bit_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, F.col("vec_id") % 100 == 0, k=10)
