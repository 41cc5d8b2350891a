"""The operators' queries: each applies one, with production parameters, to
its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import chat, decontaminate, linededup, middle, neardup, packing, pseudonym, quality, repeats, search, substrings, token_count, warc
from tessera.llm.common import table


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


#: the queries' key; a real run passes its own secret
PSEUDONYM_KEY = "tessera-example-key"


def op2_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pseudonym.pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)
    return found.select("doc_id", "text", "n_replaced")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = token_count.load_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return token_count.count_tokens(table(spark, sf_dir, "documents"), vocabulary)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(table(spark, sf_dir, "documents"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.read_back(chat.format_conversations(chat.with_probe(table(spark, sf_dir, "conversations"))))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.fuzzy_line_dedup(table(spark, sf_dir, "documents"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.dedup_windows(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle.digests(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_minhash_near_dedup, op2_pii_pseudonyms, op3_best_fit_packing, op4_warc_capture_index, op5_quality_rules, op6_token_counts, op7_benchmark_decontamination, op8_suffix_dedup, op9_chat_formatting, op10_line_dedup,
           op11_substring_dedup, op12_fill_in_middle, op13_ranked_search)}

#: DuckDB twins of the operators that SQL can express.
ORACLE: dict[str, str] = {
    "op11_substring_dedup": r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT r, w, unnest(generate_series(1, len(w) - 34)) AS s FROM words WHERE len(w) >= 35),
named AS (SELECT r, s, md5(array_to_string(w[s:s+34], ' ')) AS h FROM starts),
many AS (SELECT h FROM named GROUP BY h HAVING count(*) > 1),
hit AS (SELECT DISTINCT r, unnest(generate_series(s, s + 34)) AS p FROM named JOIN many USING (h)),
gone AS (SELECT r, count(*) AS n FROM hit GROUP BY r),
each AS (SELECT r, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM words),
kept AS (
  SELECT e.r, string_agg(e.word, ' ' ORDER BY e.p) AS text
  FROM each e LEFT JOIN hit h ON e.r = h.r AND e.p = h.p WHERE h.p IS NULL GROUP BY e.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)""",
    "op12_fill_in_middle": r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256(concat('42:', doc_id)) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
numbers AS (
  SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM units),
cut AS (
  SELECT doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b, u,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
parts AS (
  SELECT doc_id, text, n, form, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a+1:b], '') AS middle,
         array_to_string(u[b+1:], '') AS suffix FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', prefix, '<S>', suffix, '<M>', middle)
              ELSE concat('<S>', suffix, '<P>', prefix, '<M>', middle) END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts""",
    "op13_ranked_search": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
totals AS (SELECT count(*) AS nn, CAST(sum(len(w)) AS BIGINT) AS ll FROM docs WHERE len(w) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM docs) WHERE term IN (SELECT term FROM items) GROUP BY r, term),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS wt FROM tf, totals GROUP BY term, nn),
sized AS (SELECT r, doc_id, 100 - 75 + (75 * len(w) * nn) // ll AS m FROM docs, totals WHERE len(w) > 0),
scored AS (
  SELECT i, item_id, r, doc_id, CAST(sum(wt * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM items JOIN tf USING (term) JOIN weight USING (term) JOIN sized USING (r) GROUP BY i, item_id, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10""",
}
