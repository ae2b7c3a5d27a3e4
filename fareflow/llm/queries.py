"""The registered queries of the operators, with their production parameters and oracle SQL.

Each query runs its operator over the whole of its table and derives its columns from the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm import language_id, quality
from fareflow.llm.collocations import collocations
from fareflow.llm.common import crc_remainder, table
from fareflow.llm.decontaminate import contained_items
from fareflow.llm.licenses import license_matches
from fareflow.llm.line_dedup import MIN_PAGES, RATIO, drop_boilerplate
from fareflow.llm.packing import pack_documents
from fareflow.llm.simhash_dedup import near_duplicates
from fareflow.llm.suffix_dedup import without_repeats
from fareflow.llm.token_alignment import align
from fareflow.llm.token_counts import token_counts
from fareflow.llm.token_files import read_token_files, write_token_files
from fareflow.llm.topk_search import top_k
from fareflow.operators.incremental import shared_table_path

GOOD = 0.3  # quality score from which a document is good


def held_out(modulus: int, remainder: int):
    """Whether crc32 of the doc_id leaves this remainder; a null doc_id is not held out."""
    return F.coalesce(crc_remainder("doc_id", modulus) == remainder, F.lit(False))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(table(spark, sf_dir, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, ~held_out(4, 2))
    return language_id.identify(docs, model).select(
        "doc_id", held_out(4, 2).alias("held_out"), F.col("nearest").alias("lang_pred"), "score", "rejected")


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_table_path(spark, "llm-token-files")
    write_token_files(table(spark, sf_dir, "documents"), path)
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def quality_model(spark: SparkSession, sf_dir: str) -> quality.Model:
    labels = table(spark, sf_dir, "labels").where(~held_out(5, 0))
    return quality.fit(table(spark, sf_dir, "documents"), labels)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality.score_documents(table(spark, sf_dir, "documents"), quality_model(spark, sf_dir))
    return scores.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (drop_boilerplate(table(spark, sf_dir, "documents"), dropped="lines_dropped")
            .select("doc_id", "source", "lines_dropped", "n_chars", "text"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, max_distance=4)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_language_id": op2_language_id,
    "op3_topk_search": op3_topk_search,
    "op4_packing": op4_packing,
    "op5_token_files": op5_token_files,
    "op6_decontamination": op6_decontamination,
    "op7_quality": op7_quality,
    "op8_line_dedup": op8_line_dedup,
    "op9_simhash_dedup": op9_simhash_dedup,
    "op10_license_scan": op10_license_scan,
    "op11_token_alignment": op11_token_alignment,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_phrase_collocations": op13_phrase_collocations,
}


def _shingles(key: str, name: str) -> str:
    return rf"""SELECT {key}, unnest(list_distinct(CASE WHEN len(w) = 0 THEN []
                    WHEN len(w) <= 5 THEN [array_to_string(w, ' ')]
                    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s
                FROM (SELECT {key}, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM {name})"""


ORACLE_SQL: dict[str, str] = {
    "op3_topk_search": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (SELECT a.vec_id AS query_id, b.vec_id,
                          CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
                   FROM v a, v b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
        WHERE rank <= 20""",
    "op6_decontamination": f"""
        WITH d AS ({_shingles("doc_id", "documents")}),
        b AS ({_shingles("item_id", "benchmark")}),
        sizes AS (SELECT item_id, count(*) AS item_shingles FROM b GROUP BY item_id),
        hits AS (SELECT doc_id, item_id, count(*) AS matched FROM d JOIN b USING (s) GROUP BY ALL)
        SELECT doc_id, item_id, matched, item_shingles, matched / item_shingles AS containment
        FROM hits JOIN sizes USING (item_id) WHERE matched >= 0.8 * item_shingles - 1e-9""",
    "op8_line_dedup": rf"""
        WITH lines AS (SELECT row_number() OVER () AS r, source, string_split(text, chr(10)) AS l FROM documents),
        kept_keys AS (SELECT r, source, unnest(list_distinct(list_transform(l, lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')))) AS k FROM lines),
        totals AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
        bad AS (SELECT k.source, list(k.k) AS ks FROM (SELECT source, k, count(*) AS pages FROM kept_keys WHERE k <> '' GROUP BY ALL) k
                JOIN totals t ON k.source IS NOT DISTINCT FROM t.source WHERE pages >= {MIN_PAGES} AND pages / n > {RATIO} GROUP BY k.source),
        kept AS (SELECT d.doc_id, d.source, string_split(d.text, chr(10)) AS l,
                        list_filter(string_split(d.text, chr(10)),
                                    lambda x: NOT coalesce(list_contains(bad.ks, regexp_replace(x, '^\s+|\s+$', '', 'g')), false)) AS o
                 FROM documents d LEFT JOIN bad ON d.source IS NOT DISTINCT FROM bad.source)
        SELECT doc_id, source, CAST(coalesce(len(l) - len(o), 0) AS BIGINT) AS lines_dropped,
               CAST(length(array_to_string(o, chr(10))) AS BIGINT) AS n_chars, array_to_string(o, chr(10)) AS text FROM kept""",
    "op12_suffix_dedup": r"""
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
        strings AS (SELECT doc_id, p, substring(h, 2 * p + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS p FROM d)),
        repeats AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM strings) WHERE k > 1),
        marked AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS opens FROM repeats),
        spans AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b
                  FROM (SELECT doc_id, p, sum(opens) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM marked) GROUP BY doc_id, g),
        gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS after FROM spans),
        kept AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
                        string_agg(substring(h, 2 * after + 1, 2 * (a - after)), '' ORDER BY a) AS head
                 FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(head || substring(h, 2 * last + 1), h))) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op13_phrase_collocations": r"""
        WITH w AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
          FROM (SELECT lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
        grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
                  FROM w, range(1, 6) ks(k)),
        f AS (SELECT lang, k, phrase, count(*) AS c FROM grams GROUP BY ALL),
        totals AS (SELECT lang, sum(c) AS n FROM f WHERE k = 1 GROUP BY lang),
        cand AS (SELECT lang, k, phrase, c AS a, string_split(phrase, ' ') AS p FROM f WHERE k >= 2 AND c >= 100),
        cuts AS (SELECT lang, k, phrase, a, j, array_to_string(p[:j], ' ') AS lp, array_to_string(p[j + 1:], ' ') AS rp
                 FROM cand, range(1, 5) js(j) WHERE j < k),
        scored AS (SELECT c.lang, c.phrase, a, j, l.c AS l, r.c AS r, n, (1000::HUGEINT * a * n) // (l.c::HUGEINT * r.c) AS score
                   FROM cuts c JOIN f l ON c.lang = l.lang AND c.lp = l.phrase AND l.k = c.j JOIN f r ON c.lang = r.lang AND c.rp = r.phrase AND r.k = c.k - c.j
                   JOIN totals t ON t.lang = c.lang),
        low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
        inner_ AS (SELECT lang, a, k, unnest(flatten(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2), lambda i: array_to_string(p[i:i + m - 1], ' '))))) AS phrase FROM cand),
        gone AS (SELECT DISTINCT i.lang, i.phrase FROM inner_ i JOIN cand c ON c.lang = i.lang AND c.phrase = i.phrase AND i.a * 100 >= c.a * 100)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
        FROM low ANTI JOIN gone USING (lang, phrase) QUALIFY rank <= 2000""",
}
