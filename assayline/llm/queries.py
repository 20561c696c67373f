"""The registered queries of the thirteen operators, each over its whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayline.llm import (
    complement_packing,
    decontamination,
    fill_middle,
    licenses,
    merkle,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    secrets,
    simhash,
    substrings,
    token_counts,
)
from assayline.llm.frames import table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
TOKEN_LIMIT = 2048


def op1_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark item that a document holds, with its best window."""
    found = decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("_a", "_b")


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = substrings.remove_repeats(table(spark, folder, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        *[pii.count_of("spans", kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS],
        F.sha2(pii.listed("spans", pii.BASE_KINDS), 256).alias("base_sha256"),
        pii.listed("spans").alias("spans"),
    )


def op4_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        *[pii.count_of("spans", kind).alias(f"n_{kind}") for kind in secrets.BASE_KINDS],
        F.sha2(pii.listed("spans", secrets.BASE_KINDS), 256).alias("base_sha256"),
        pii.listed("spans").alias("spans"),
    )


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    answered = token_counts.budget_answers(table(spark, folder, "documents"), TOKENIZER, TOKEN_LIMIT)
    over = F.col("n_tokens") > TOKEN_LIMIT
    return answered.select("doc_id", "n_bytes", "n_tokens", over.alias("over_limit"))


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return quality_rules.judged(documents, quality_rules.fit(documents, labels))


def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return quality_classifier.scored(documents, quality_classifier.fit(documents, labels))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), TOKENIZER)


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    found = licenses.license_notices(documents, licenses.templates(spark), licenses.passages(spark))
    return found.drop("_a", "_b")


def op11_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return complement_packing.pack(table(spark, folder, "documents"), TOKENIZER)


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every third document, by its id's checksum, is tampered with: its capitals are lowered."""
    key = F.col("doc_id").cast("string").cast("binary")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    observed = F.when(F.crc32(key) % 3 == 0, lowered).otherwise(F.col("text"))
    return merkle.audit(table(spark, folder, "documents"), observed)


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_middle.transform(table(spark, folder, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(), 256).alias("restored_sha256"),
    )


def registered() -> dict[str, Query]:
    listed = (
        op1_benchmark_decontamination,
        op2_substring_dedup,
        op3_pii,
        op4_simhash_near_dedup,
        op5_secret_scan,
        op6_token_counts,
        op7_quality_rules,
        op8_quality_classifier,
        op9_packing,
        op10_license_scan,
        op11_best_fit_packing,
        op12_merkle_manifest,
        op13_fill_in_middle,
    )
    return {function.__name__: function for function in listed}


OP2_SQL = r"""
WITH worded AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
),
placed AS (
    SELECT doc_id, unnest(range(1, len(words) - 48)) AS start, words FROM worded WHERE len(words) >= 50
),
windows AS (
    SELECT doc_id, start, array_to_string(words[start : start + 49], ' ') AS content FROM placed
),
firsts AS (SELECT content, min(doc_id) AS first_id FROM windows GROUP BY content),
covered AS (
    SELECT DISTINCT w.doc_id, unnest(range(w.start, w.start + 50)) AS place
    FROM windows w JOIN firsts f ON w.content = f.content AND f.first_id < w.doc_id
),
removed AS (SELECT doc_id, list(place) AS places FROM covered GROUP BY doc_id)
SELECT w.doc_id,
       CAST(len(w.words) AS BIGINT) AS n_words,
       CAST(coalesce(len(r.places), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(
           CASE WHEN r.places IS NULL THEN w.words
                ELSE [w.words[i] FOR i IN range(1, len(w.words) + 1) IF NOT list_contains(r.places, i)] END,
           ' ')) AS kept_sha256
FROM worded w LEFT JOIN removed r ON w.doc_id = r.doc_id
"""


def _op10_sql() -> str:
    listed = ",\n    ".join(f"('{name}', '{text}')" for name, text in licenses.TEMPLATES)
    return rf"""
WITH notices(license_id, text) AS (VALUES
    {listed}
),
lined AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS run,
           unnest(range(len(string_split(text, chr(10))))) AS line
    FROM documents
),
worded AS (
    SELECT doc_id, line,
           string_split(trim(regexp_replace(lower(run), '[^a-z0-9]+', ' ', 'g')), ' ') AS words FROM lined
),
noted AS (
    SELECT license_id, string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ') AS words
    FROM notices
),
line_pairs AS (
    SELECT doc_id, line, list_distinct([words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))]) AS pairs
    FROM worded WHERE len(words) >= 2
),
notice_pairs AS (
    SELECT license_id, list_distinct([words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))]) AS pairs
    FROM noted
),
compared AS (
    SELECT l.doc_id, l.line, n.license_id,
           2.0 * len(list_intersect(l.pairs, n.pairs)) / (len(l.pairs) + len(n.pairs)) AS dice
    FROM line_pairs l JOIN notice_pairs n
      ON 2 * least(len(l.pairs), len(n.pairs)) >= {licenses.SIMILARITY} * (len(l.pairs) + len(n.pairs))
)
SELECT doc_id, CAST(line AS BIGINT) AS line, license_id, CAST(dice AS DOUBLE) AS dice
FROM compared WHERE dice >= {licenses.SIMILARITY}
QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, license_id) = 1
"""


OP12_SQL = """
WITH RECURSIVE stated AS (
    SELECT lang, doc_id, text, CAST(doc_id AS VARCHAR) AS id,
           coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
           || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
           || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head
    FROM documents
),
summed AS (  -- crc32 of the decimal id, bit by bit
    SELECT *, xor(CAST(4294967295 AS UBIGINT), list_reduce(
        list_prepend(CAST(4294967295 AS UBIGINT), [CAST(ascii(c) AS UBIGINT) FOR c IN string_split(id, '')]),
        lambda crc, b: list_reduce(
            list_prepend(xor(crc, b), [CAST(0 AS UBIGINT) FOR i IN range(8)]),
            lambda x, z: xor(x >> 1, CAST(3988292384 AS UBIGINT) * (x & 1))))) AS crc
    FROM stated
),
hashed AS (
    SELECT lang, doc_id, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           sha256(head || coalesce(strlen(text) || ':' || CASE WHEN crc % 3 = 0
               THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
               ELSE text END, '-')) AS seen
    FROM summed
),
leaves AS (
    SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, seen) - 1 AS place,
           count(*) OVER (PARTITION BY lang) AS width
    FROM hashed
),
levels(tree, level, place, digest, width) AS (
    SELECT tree, CAST(0 AS BIGINT), place, leaf, width FROM leaves
    UNION ALL
    SELECT tree, level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place)), (any_value(width) + 7) // 8
    FROM levels WHERE width > 1 GROUP BY tree, level, place // 8
),
tops(level, place, digest, width) AS (
    SELECT CAST(0 AS BIGINT), tree, digest, (SELECT count(DISTINCT tree) FROM leaves) FROM levels WHERE width = 1
    UNION ALL
    SELECT level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place)), (any_value(width) + 7) // 8
    FROM tops WHERE width > 1 GROUP BY level, place // 8
),
ends AS (SELECT tree, level AS height, digest AS subroot FROM levels WHERE width = 1),
paths(tree, leaf_place, level, place, folded, siblings) AS (
    SELECT tree, place, CAST(0 AS BIGINT), place, seen, '' FROM leaves
    UNION ALL
    SELECT p.tree, p.leaf_place, p.level + 1, p.place // 8,
           sha256(string_agg(CASE WHEN n.place = p.place THEN p.folded ELSE n.digest END, '' ORDER BY n.place)),
           p.siblings || coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place <> p.place), '')
    FROM paths p JOIN levels n ON n.tree = p.tree AND n.level = p.level AND n.place // 8 = p.place // 8
    WHERE n.width > 1
    GROUP BY p.tree, p.leaf_place, p.level, p.place, p.folded, p.siblings
),
top_paths(tree, leaf_place, level, place, folded, siblings) AS (
    SELECT p.tree, p.leaf_place, CAST(0 AS BIGINT), p.tree, p.folded, p.siblings
    FROM paths p JOIN ends e ON p.tree = e.tree AND p.level = e.height
    UNION ALL
    SELECT p.tree, p.leaf_place, p.level + 1, p.place // 8,
           sha256(string_agg(CASE WHEN n.place = p.place THEN p.folded ELSE n.digest END, '' ORDER BY n.place)),
           p.siblings || coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place <> p.place), '')
    FROM top_paths p JOIN tops n ON n.level = p.level AND n.place // 8 = p.place // 8
    WHERE n.width > 1
    GROUP BY p.tree, p.leaf_place, p.level, p.place, p.folded, p.siblings
),
top AS (SELECT level, digest AS root FROM tops WHERE width = 1)
SELECT l.doc_id, l.leaf, e.subroot, t.root, sha256(p.siblings) AS proof_sha256, p.folded AS folded_root,
       p.folded = t.root AS verified
FROM leaves l JOIN ends e USING (tree) CROSS JOIN top t
JOIN top_paths p ON p.tree = l.tree AND p.leaf_place = l.place AND p.level = t.level
"""


OP13_SQL = r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
           sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS drawn
    FROM documents
),
numbered AS (
    SELECT doc_id, text, units, CAST(len(units) AS BIGINT) AS n,
           CAST('0x' || drawn[1:8] AS UBIGINT) AS h1, CAST('0x' || drawn[9:16] AS UBIGINT) AS h2,
           CAST('0x' || drawn[17:24] AS UBIGINT) AS h3, CAST('0x' || drawn[25:32] AS UBIGINT) AS h4
    FROM cut
),
formed AS (
    SELECT doc_id, text, units, n,
           CAST(least(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS low,
           CAST(greatest(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS high,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR h3 % 100 >= 50 THEN 'plain'
                WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM numbered
),
parted AS (
    SELECT doc_id, text, n, form,
           coalesce(array_to_string(units[1:low], ''), '') AS prefix,
           coalesce(array_to_string(units[low + 1:high], ''), '') AS middle,
           coalesce(array_to_string(units[high + 1:], ''), '') AS suffix
    FROM formed
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parted
"""


def oracle_sql() -> dict[str, str]:
    """Where SQL can say it; the other operators are tested against brute force."""
    return {
        "op2_substring_dedup": OP2_SQL,
        "op10_license_scan": _op10_sql(),
        "op12_merkle_manifest": OP12_SQL,
        "op13_fill_in_middle": OP13_SQL,
    }
