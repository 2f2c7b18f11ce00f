"""The queries of this folder: thin wrappers that derive the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.session import table


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.llm.exact_dedup import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.llm.quality_rules import score_quality

    scored = score_quality(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.llm.mixing import mix_rates

    return mix_rates(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.llm.ngram_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), width=4, percent=85)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from textloom.llm.bpe import bpe_digest

    return bpe_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.llm.chat_format import format_chats

    out = format_chats(table(spark, sf_dir, "conversations"))
    return out.select("conv_id", "turn", "given", "role", F.length("rendered").cast("long").alias("n_chars"), F.sha2("rendered", 256).alias("rendered_sha256"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.llm.repeated_bytes import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.llm.substring_dedup import substring_dedup

    return substring_dedup(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.llm.pii import detect_pii

    out = detect_pii(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_id", "n_secret", "n_account", "n_tel", "n_spans")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.llm.toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.llm.vp_trees import nearest_neighbours

    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.llm.phrases import mine_phrases

    return mine_phrases(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.llm.vector_codes import encode_vectors

    return encode_vectors(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_mixing": op3_mixing,
    "op4_ngram_join": op4_ngram_join,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_pii": op7_pii,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_bpe": op9_bpe,
    "op10_toxicity": op10_toxicity,
    "op11_nearest_neighbours": op11_nearest_neighbours,
    "op12_phrases": op12_phrases,
    "op13_vector_codes": op13_vector_codes,
}

def phrases_sql(longest: int = 5, least: int = 100, top: int = 2000) -> str:
    """DuckDB SQL of op12: all n-grams of all pieces as lists, without a dictionary or keys."""
    return rf"""
        WITH pieces AS (
          SELECT coalesce(lang, 'und') AS lang,
            unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents),
        lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS p FROM lists),
        grams AS (SELECT lang, w[p : p + k - 1] AS g, k, p FROM places, range(1, {longest + 1}) t(k) WHERE p + k - 1 <= len(w)),
        f AS MATERIALIZED (SELECT lang, g, k, count(*) AS n FROM grams GROUP BY ALL HAVING count(*) >= {least}),
        totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY lang),
        cuts AS (
          SELECT c.lang, c.g, c.n AS a, t.n, cut, x.n AS l, y.n AS r,
            ((1000::HUGEINT * c.n * t.n) // (x.n::HUGEINT * y.n))::BIGINT AS score
          FROM f c JOIN totals t USING (lang), range(1, {longest}) u(cut), f x, f y
          WHERE c.k > 1 AND cut < c.k AND x.lang = c.lang AND x.g = c.g[1 : cut] AND y.lang = c.lang AND y.g = c.g[cut + 1 :]),
        lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
        longer AS (
          SELECT lang, g[s : s + k - 1] AS g, max(n) AS n
          FROM (SELECT lang, g, n, k AS whole FROM f) h, range(2, {longest}) v(k), range(1, {longest + 1}) z(s)
          WHERE k < whole AND s + k - 1 <= whole GROUP BY ALL),
        left_over AS (SELECT * FROM lowest WHERE NOT EXISTS (SELECT 1 FROM longer o WHERE o.lang = lowest.lang AND o.g = lowest.g AND 100 * o.n >= 100 * lowest.a))
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank, array_to_string(g, ' ') AS phrase, a, l, r, n, score
        FROM left_over QUALIFY rank <= {top}"""


def codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """DuckDB SQL of op13: each round compares every part with every entry."""
    nearest = "SELECT x.n, x.p, arg_min(b.e, (list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT, b.e)) AS e"
    steps = []
    for k in range(rounds + 1):
        steps.append(f"a{k} AS MATERIALIZED ({nearest} FROM x JOIN b{k} b USING (p) GROUP BY x.n, x.p)")
        if k < rounds:
            steps.append(f"m{k} AS (SELECT p, e, i, sum(v[i])::HUGEINT AS s, count(*)::HUGEINT AS c FROM a{k} JOIN x USING (n, p), range(1, len(v) + 1) t(i) GROUP BY ALL)")
            steps.append(f"v{k} AS (SELECT p, e, list(((s - ((s % c) + c) % c) // c)::BIGINT ORDER BY i) AS v FROM m{k} GROUP BY p, e)")
            steps.append(f"b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(w.v, b.v) AS v FROM b{k} b LEFT JOIN v{k} w USING (p, e))")
    steps_sql = ",\n        ".join(steps)
    return f"""
        WITH k AS (
          SELECT row_number() OVER (ORDER BY vec_id) AS n, vec_id, label, embedding FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        x AS MATERIALIZED (
          SELECT n, p, list_transform(embedding[p * len(embedding) // {parts} + 1 : (p + 1) * len(embedding) // {parts}], lambda c: floor({scale} * c::DOUBLE)::BIGINT) AS v
          FROM k, range({parts}) t(p)),
        b0 AS MATERIALIZED (SELECT p, n - 1 AS e, v FROM x WHERE n <= {entries}),
        {steps_sql},
        coded AS (
          SELECT n, string_agg(printf('%02x', a.e), '' ORDER BY p) AS code,
            sum(list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))))::BIGINT AS error
          FROM a{rounds} a JOIN x USING (n, p) JOIN b{rounds} b USING (p, e) GROUP BY n)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
          (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
        FROM coded JOIN k USING (n)"""


ORACLES: dict[str, str] = {
    "op12_phrases": phrases_sql(),
    "op13_vector_codes": codes_sql(),
    "op8_exact_dedup": r"""
        WITH d AS (
          SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS sha
          FROM documents)
        SELECT doc_id,
          first_value(doc_id) OVER w AS keep_id,
          count(*) OVER (PARTITION BY sha) AS group_size,
          doc_id = first_value(doc_id) OVER w AS kept,
          sha AS text_sha256
        FROM d WINDOW w AS (PARTITION BY sha ORDER BY n DESC, doc_id)""",
}
