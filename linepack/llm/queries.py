"""The registered queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    block_anchors,
    context_mixing,
    cotraining,
    digest_mph,
    license_scan,
    mean_order,
    merge_replay,
    middle_fill,
    packing,
    pareto_mix,
    pruned_graph,
    ragged_bpe,
    simhash_ball,
)

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_digest(license_scan.scan(_documents(spark, sf_dir)))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_ball.near_duplicates(_documents(spark, sf_dir), radius=4, width=4)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_mph.exact_duplicates(_documents(spark, sf_dir))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ragged_bpe.token_counts(
        _documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, limit=1024
    )


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = pareto_mix.mix(_documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_replay.round_trip_digests(
        _documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_anchors.substring_dedup(_documents(spark, sf_dir))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pruned_graph.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), threshold=0.98)


def op9_packed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(
        _documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, row_tokens=2048
    )


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.quality_scores(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle_fill.fill_digest(middle_fill.fill_in_middle(_documents(spark, sf_dir)))


def op12_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.scored(_documents(spark, sf_dir))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mean_order.clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_source_mix": op5_source_mix,
    "op6_bpe_round_trip": op6_bpe_round_trip,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_packed_rows": op9_packed_rows,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_lm_scores": op12_lm_scores,
    "op13_centroid_clustering": op13_centroid_clustering,
}

SPACES = r"[\x20\x09-\x0D]+"

LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def license_sql() -> str:
    """Phrases by their places, notices by comparing every line with every template."""
    def strings(values) -> str:
        return "[" + ", ".join(f"'{v.decode()}'" for v in values) + "]"

    phrases = ", ".join(
        f"({strings(license_scan.words(phrase))}, '{label}')" for phrase, label in license_scan.PHRASES.items()
    )
    known = license_scan.template_list(license_scan.TEMPLATES, license_scan.THRESHOLD)
    templates = ", ".join(f"('{t.label}', {strings(sorted(t.tokens))}, {t.need})" for t in known)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
        WITH d AS (
          SELECT doc_id, translate(coalesce(text, ''), '{upper}', '{lower}') AS t FROM documents
        ), w AS (
          SELECT doc_id, t, regexp_extract_all(t, '{LICENSE_WORD}') AS w FROM d
        ), phrase(p, label) AS (
          VALUES {phrases}
        ), place AS (
          SELECT doc_id, label, unnest(list_filter(range(0, len(w) - len(p) + 1), lambda i: w[i + 1 : i + len(p)] = p)) AS spot
          FROM w, phrase WHERE list_has_all(w, p)
        ), base AS (
          SELECT doc_id, count(*) AS n_base, min(spot) AS first_word, max(spot) AS last_word, list(DISTINCT label) AS labels
          FROM place GROUP BY doc_id
        ), line AS (
          SELECT doc_id, regexp_extract_all(unnest(string_split(t, chr(10))), '{LICENSE_WORD}') AS w FROM d
        ), template(label, tokens, need) AS (
          VALUES {templates}
        ), notice AS (
          SELECT doc_id, list(DISTINCT label) AS labels, max(len(list_intersect(tokens, w)) / len(tokens)::DOUBLE) AS best
          FROM line, template WHERE len(list_intersect(tokens, w)) >= need GROUP BY doc_id
        )
        SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
               first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
               coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
               coalesce(array_to_string(list_sort(list_distinct(list_concat(base.labels, notice.labels))), ','), '') AS labels,
               CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
        FROM w LEFT JOIN base USING (doc_id) LEFT JOIN notice USING (doc_id)"""


SUBSTRING_SQL = r"""
    WITH d AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
    ), s AS (
      SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13
    ), v AS (
      SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS t FROM s
    ), r AS (
      SELECT doc_id, i, min(doc_id) OVER (PARTITION BY t) < doc_id AS later FROM v
    ), g AS (
      SELECT doc_id, list_distinct(flatten(list(range(i, i + 13)))) AS gone FROM r WHERE later GROUP BY doc_id
    ), k AS (
      SELECT d.doc_id, len(w) AS n, coalesce(len(gone), 0) AS n_gone,
             CASE WHEN gone IS NULL THEN w ELSE list_where(w, list_transform(range(1, len(w) + 1), lambda j: NOT list_contains(gone, j))) END AS kept
      FROM d LEFT JOIN g USING (doc_id)
    )
    SELECT doc_id, n::BIGINT AS n_words, n_gone::BIGINT AS n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k"""


#: One more document next in size to what is missing.
MIX_PLACE = """, p{n} AS (
          SELECT *, row_number() OVER (PARTITION BY source, spare AND size < 2 * rest ORDER BY abs(size - rest), rank, doc_id, size) = 1
                 AND spare AND size < 2 * rest AS now FROM g{before}
        ), g{n} AS (
          SELECT * EXCLUDE (now, last, spare, rest), last OR now AS last, spare AND NOT now AS spare,
                 rest - coalesce(sum(CASE WHEN now THEN size END) OVER (PARTITION BY source), 0) AS rest FROM p{n}
        )"""


MIDDLE_SQL = """
    WITH d AS (
      SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
    ), r AS (
      SELECT doc_id, t, n, [('0x' || substr(h, 8 * k + 1, 8))::BIGINT FOR k IN range(4)] AS h FROM d
    ), c AS (
      SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
                  WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM r
    ), p AS (
      SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM c
    )
    SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                  ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
           sha256(t) AS restored_sha256 FROM p"""


#: The nearest of the centroids c{n}, and the centroids after it.
CLUSTER_ROUND = """, a{n} AS (
      SELECT row, any_value(v.v) AS v, arg_min(c, 16 * gap + c) AS c, min(gap) AS gap FROM (
        SELECT row, c, v.v, list_sum([(v.v[i] - c{n}.v[i]) * (v.v[i] - c{n}.v[i]) FOR i IN range(1, 65)])::BIGINT AS gap FROM v, c{n}
      ) AS v GROUP BY row
    ), c{after} AS (
      SELECT c, coalesce(list(floor ORDER BY i), any_value(c{n}.v)) AS v FROM c{n} LEFT JOIN (
        SELECT c, i, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS floor
        FROM (SELECT c, unnest(range(1, 65)) AS i, unnest(v) AS x FROM a{n}) GROUP BY c, i
      ) USING (c) GROUP BY c
    )"""

CLUSTER_SQL = f"""
    WITH v AS (
      SELECT row_number() OVER () AS row, vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
      WHERE len(embedding) = 64 AND len([1 FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64
    ), c0 AS (
      SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c, v FROM v
      ORDER BY c LIMIT 16
    ){"".join(CLUSTER_ROUND.format(n=n, after=n + 1) for n in range(4))}
    SELECT vec_id, a3.c::INTEGER AS cluster, gap AS distance, sum(gap) OVER (PARTITION BY a3.c)::BIGINT AS cluster_inertia,
           sum(gap) OVER ()::BIGINT AS inertia, sha256(array_to_string(c3.v, ',')) AS centroid_sha256
    FROM a3 JOIN v USING (row) JOIN c3 ON a3.c = c3.c"""


ORACLES: dict[str, str] = {
    "op11_fill_in_middle": MIDDLE_SQL,
    "op13_centroid_clustering": CLUSTER_SQL,
    "op7_substring_dedup": SUBSTRING_SQL,
    "op1_license_scan": license_sql(),
    "op3_exact_dedup": rf"""
        WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{SPACES}', ' ', 'g')) AS h FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, h AS text_sha256
        FROM n WINDOW g AS (PARTITION BY h)""",
    "op5_source_mix": rf"""
        WITH d AS (
          SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
        ), s AS (
          SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
        ), w AS (
          SELECT *, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS w FROM s
        ), f AS (
          SELECT *, 3.0::DOUBLE * source_size / w AS full_at FROM w
        ), l AS (
          SELECT *, (sum(source_size) OVER ()::DOUBLE - 3.0::DOUBLE * coalesce(sum(source_size) OVER
                     (ORDER BY full_at, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
                 / sum(w) OVER (ORDER BY full_at, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS share
          FROM f
        ), c AS (
          SELECT full_at AS level, share FROM l WHERE share <= full_at ORDER BY full_at, source IS NULL, source LIMIT 1
        ), t AS (
          SELECT source, source_size,
                 CASE WHEN full_at < level THEN 3.0::DOUBLE * source_size ELSE w * c.share END AS target FROM l, c
        ), x AS (
          SELECT d.doc_id, d.size, t.source, t.source_size, t.target,
                 CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS times,
                 (('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
        ), y AS (
          SELECT *, floor(times)::BIGINT AS whole, times - floor(times) AS f,
                 target - floor(times)::BIGINT * source_size AS need FROM x
        ), z AS (
          SELECT *, CASE WHEN f > 0 AND size > 0 THEN (u / (1 - u)) / (f / (1 - f)) END AS odds FROM y
        ), r AS (
          SELECT *, odds / (1 + odds) AS rank, CASE WHEN odds IS NOT NULL THEN sum(size) OVER
            (PARTITION BY source, odds IS NULL ORDER BY odds / (1 + odds), doc_id, size ROWS UNBOUNDED PRECEDING) END AS upto FROM z
        ), k AS (
          SELECT *, coalesce(upto <= need, false) AS fits FROM r
        ), g0 AS (
          SELECT *, need - coalesce(sum(CASE WHEN fits THEN size END) OVER (PARTITION BY source), 0) AS rest,
                 NOT fits AND odds IS NOT NULL AS spare, false AS last FROM k
        ){"".join(MIX_PLACE.format(n=n, before=n - 1) for n in range(1, pareto_mix.LAST_PLACES + 1))}
        SELECT doc_id, size, source_size, target, whole + (fits OR last)::INT AS copies,
               (whole + (fits OR last)::INT) * size AS taken FROM g{pareto_mix.LAST_PLACES}""",
}
