"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import decontamination, fingerprints, html_extraction, mixing, ngram_jaccard, sharding, suffix_dedup, token_counts, token_output, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.classes(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.main_text(table(spark, sf_dir, "pages"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_output(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return mixing.mix(documents, labels, {"plain": 0.8, "poor": 0.1, "toxic": 0.1})


def queries() -> dict:
    return {
        f.__name__: f
        for f in (
            op1_ngram_jaccard,
            op2_suffix_dedup,
            op3_document_fingerprints,
            op4_decontamination,
            op5_html_extraction,
            op6_token_counts,
            op7_token_output,
            op8_sharding,
            op9_toxicity,
            op10_mixing,
        )
    }


#: Sets of 4-word shingles, links at 85 in 100, their number, and the least document reachable.
OP1_SQL = r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS h FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * shared >= 85 * (a.n + b.n - shared)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, coalesce(k.n, 0)::BIGINT AS n_links FROM documents d LEFT JOIN n USING (doc_id)
  JOIN (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x) c USING (doc_id) LEFT JOIN (SELECT x AS doc_id, count(*) AS n FROM e GROUP BY x) k USING (doc_id)"""

#: Every window that holds a shingle of an item, scored in full.
OP4_SQL = r"""WITH dw AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM (SELECT DISTINCT doc_id, text FROM documents)),
iw AS (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
d AS (SELECT doc_id, len(w) - 4 AS total, i - 1 AS pos, array_to_string(w[i:i + 4], ' ') AS h FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i FROM dw WHERE len(w) > 4)),
b AS (SELECT item_id, n, h, count(*) AS c FROM (SELECT item_id, len(w) - 4 AS n, array_to_string(w[i:i + 4], ' ') AS h FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i FROM iw WHERE len(w) > 4)) GROUP BY ALL),
hits AS (SELECT doc_id, item_id, n, c, pos, h, total, least(n, total) AS m FROM d JOIN b USING (h)),
starts AS (SELECT DISTINCT doc_id, item_id, n, m, start FROM (SELECT *, unnest(range(greatest(0, pos - m + 1), least(pos, total - m) + 1)) AS start FROM hits)),
scored AS (SELECT doc_id, item_id, n, m, start, sum(k) AS shared FROM (SELECT s.doc_id, s.item_id, s.n, s.m, s.start, least(count(*), c) AS k FROM starts s JOIN hits x ON x.doc_id = s.doc_id AND x.item_id = s.item_id
  AND x.pos BETWEEN s.start AND s.start + s.m - 1 GROUP BY s.doc_id, s.item_id, s.n, s.m, s.start, x.h, c) GROUP BY ALL),
best AS (SELECT *, (shared::BIGINT)::DOUBLE / (m + n - shared::BIGINT) AS similarity FROM scored)
SELECT doc_id, item_id, max(similarity) AS similarity, (arg_min(start, (-similarity, start)))::INT AS start_word FROM best WHERE similarity >= 0.8 GROUP BY doc_id, item_id"""

#: The marked article, block by block, as the markup of the test pages allows it in SQL.
OP5_SQL = r"""SELECT page_id, url, text, length(text) AS n_chars FROM (SELECT page_id, url, array_to_string(list_filter(list_transform(
  string_split_regex(regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1), '</?(?:p|h1)>'),
  lambda x: trim(regexp_replace(replace(replace(replace(replace(regexp_replace(x, '</?b>|<br>', '', 'g'), '&quot;', '"'), '&middot;', '·'), '&copy;', '©'), '&amp;', '&'), '\s+', ' ', 'g'))),
  lambda x: x <> ''), chr(10)) AS text FROM pages)"""


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_jaccard": OP1_SQL, "op4_decontamination": OP4_SQL, "op5_html_extraction": OP5_SQL}
