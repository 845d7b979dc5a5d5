"""One query per operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from candela.llm import bpe, exact_dedup, fill_in_middle, filter_audit, jaccard_join, language, mixing, multi_index, quality, repetition, token_counts, token_files, toxicity
from candela.llm.common import table


def op1_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op3_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op4_grouped_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_overlap_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op7_extendible_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_seekable_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32")


def op9_flow_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_backtracking_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digest(table(spark, sf_dir, "documents"))


def op11_repetition_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op12_secondary_sort_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))


def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_compression_quality,
        op2_inverted_multi_index,
        op3_language_mixture,
        op4_grouped_prefix_join,
        op5_factorization_machine,
        op6_overlap_token_counts,
        op7_extendible_hash_dedup,
        op8_seekable_token_files,
        op9_flow_mixing,
        op10_backtracking_bpe,
        op11_repetition_coverage,
        op12_secondary_sort_fim,
        op13_filter_interactions,
    )
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_NGRAMS = ", ".join(f"({n}, {p})" for n, p in repetition.NGRAM_PERCENT.items())
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES: dict[str, str] = {
    "op4_grouped_prefix_join": rf"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                   ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words
        ), items AS (
            SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets
        ), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.t = b.t AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
        ), reach AS (
            SELECT a AS doc_id, a AS other FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
        )
        SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(min(r.other), s.doc_id)) AS component_id
        FROM sets s LEFT JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.s
    """,
    "op7_extendible_hash_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_repetition_coverage": rf"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents
        ), sizes AS (
            SELECT n, percent FROM (VALUES {_NGRAMS}) v(n, percent)
        ), items AS (
            SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS pos FROM docs
        ), ahead AS (
            SELECT r, pos, list(x) OVER (PARTITION BY r ORDER BY pos ROWS BETWEEN CURRENT ROW AND {max(repetition.NGRAM_PERCENT) - 1} FOLLOWING) AS xs FROM items
        ), grams AS (
            SELECT r, n, pos, array_to_string(xs[1:n], ' ') AS g FROM ahead, sizes WHERE len(xs) >= n
        ), found AS (
            SELECT r, n, min(pos) AS head, unnest(list(pos)) AS pos FROM grams GROUP BY r, n, g HAVING count(*) > 1
        ), places AS (
            SELECT DISTINCT r, n, unnest(range(pos, pos + n)) AS pos FROM found WHERE pos > head
        ), covered AS (
            SELECT r, n, sum(length(x)) AS chars FROM places JOIN items USING (r, pos) GROUP BY r, n
        ), repeats AS (
            SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(pos, pos + n)) AS place FROM found WHERE n = {repetition.BASE_WINDOW}) GROUP BY r
        ), lines AS (
            SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs
        ), same AS (
            SELECT r, count(*) - 1 AS more, (count(*) - 1) * length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars
            FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r, line
        ), dup AS (
            SELECT r, sum(more) AS n, sum(chars) AS chars FROM same GROUP BY r
        ), over AS (
            SELECT c.r FROM covered c JOIN sizes USING (n) JOIN docs d ON d.r = c.r WHERE 100 * c.chars > percent * length(array_to_string(w, ''))
        ), base AS (
            SELECT d.r, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                   CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
                   CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words, coalesce(dup.chars, 0) AS line_chars
            FROM docs d LEFT JOIN repeats ON repeats.r = d.r LEFT JOIN dup ON dup.r = d.r
        ), judged AS (
            SELECT *, n_words < {repetition.MIN_WORDS} OR 100 * n_repeat_words > {repetition.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM base
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND 100 * line_chars <= {repetition.LINE_PERCENT} * word_chars AND r NOT IN (SELECT r FROM over) AS kept
        FROM judged
    """,
    "op12_secondary_sort_fim": r"""
        WITH cut AS (
            SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
                   sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
        ), drawn AS (
            SELECT doc_id, t, u, len(u) AS n, ('0x' || h[1:8])::UBIGINT % (len(u) + 1) AS c1, ('0x' || h[9:16])::UBIGINT % (len(u) + 1) AS c2,
                   ('0x' || h[17:24])::UBIGINT % 100 AS r3, ('0x' || h[25:32])::UBIGINT % 100 AS r4 FROM cut
        ), formed AS (
            SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r3 >= 50 THEN 'plain' WHEN r4 < 80 THEN 'spm' ELSE 'psm' END AS form,
                   array_to_string(u[1:least(c1, c2)], '') AS p, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m, array_to_string(u[greatest(c1, c2) + 1:], '') AS s
            FROM drawn
        )
        SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM formed
    """,
    "op13_filter_interactions": rf"""
        WITH words AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {_WORDS} AS w FROM documents
        ), bits AS (
            SELECT part, coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL), false) AS good,
                   coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL), false) AS toxic,
                   MAP {{'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w), 'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
                        'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)}} AS fails
            FROM words
        ), combos AS (
            SELECT part, fails, good, toxic, count(*) AS n FROM bits GROUP BY ALL
        ), letters AS (
            SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
        ), orders AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
        ), steps AS (
            SELECT o, step, o[step] AS f, list_filter(string_split(o[1:step - 1], ''), lambda x: x <> '') AS before FROM orders, (SELECT unnest(range(1, 6)) AS step)
        ), hit AS (
            SELECT part, o, step, f, n, good, toxic, fails[f] AS fail, len(list_filter(before, lambda x: fails[x])) > 0 AS gone,
                   len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: fails[x])) AS failures FROM combos, steps
        ), counted AS (
            SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step, f, CAST(coalesce(sum(n) FILTER (WHERE NOT fail AND NOT gone), 0) AS BIGINT) AS kept,
                   CAST(coalesce(sum(n) FILTER (WHERE fail AND NOT gone), 0) AS BIGINT) AS removed, CAST(coalesce(sum(n) FILTER (WHERE fail AND gone), 0) AS BIGINT) AS redundant,
                   CAST(coalesce(sum(n) FILTER (WHERE fail AND failures = 1), 0) AS BIGINT) AS unique_fails,
                   CAST(coalesce(sum(n) FILTER (WHERE fail AND NOT gone AND good), 0) AS BIGINT) AS good_lost,
                   CAST(coalesce(sum(n) FILTER (WHERE fail AND NOT gone AND toxic), 0) AS BIGINT) AS toxic_lost
            FROM hit GROUP BY part, o, step, f
        )
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM counted
    """,
}
