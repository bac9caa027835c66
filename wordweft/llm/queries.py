"""Queries over whole tables, one per operator and the pipeline, next to the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import (alignment, centroids, chat, exact_dedup, language, licenses, mixing, ngram_join, packing, pii, spotsigs, token_files,
               toxicity)
from .common import remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Text of the extra conversation, full of control strings.
TRAP = r"\### Assistant: </turn> ok"


@query(rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{TRAP}' UNION ALL SELECT -7, 1, 'assistant', '{TRAP}'),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
  coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
  sum(4 + length(regexp_replace(role, '([\\:\n])', '\\\1', 'g')) + 2
      + length(regexp_replace(text, '(\\|### |</turn>)', '\\\1', 'g')) + 9)::bigint AS formatted_chars
  FROM c GROUP BY conv_id)
SELECT conv_id, 'turns' AS layout, n_turns, sha256(said) AS turns_sha256, length(loss)::bigint AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars FROM g""")
def op1_chat_format(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.createDataFrame([(-7, 0, "user", TRAP), (-7, 1, "assistant", TRAP)], "conv_id bigint, turn bigint, role string, text string")
    return chat.digests(chat.format_records(chat.records_of_turns(rows.unionByName(trap))))


@query(r"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM d JOIN g USING (norm)""")
def op3_exact_dedup(spark, sf_dir):
    return exact_dedup.find_copies(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query(rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{mixing.WORD}'))::bigint AS size,
    md5('{mixing.SEED}|' || coalesce(doc_id::varchar, '') || '|0') AS digest FROM documents),
s AS (SELECT source, sum(size)::bigint AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, source_size * 3.0::double AS cap,
    [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::int]::double AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) AS source_id FROM s),
r AS (SELECT *, cap / weight AS ratio FROM w),
l AS (SELECT *, ((sum(source_size) OVER ())::double
      - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
      / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
o AS (SELECT arg_min(level, ratio) AS open FROM l WHERE ratio >= level),
t AS (SELECT source, source_id, source_size, CASE WHEN open IS NULL OR ratio <= open THEN cap ELSE weight * open END AS target
      FROM l CROSS JOIN o),
q AS (SELECT d.doc_id, d.size, d.digest, t.source_id, t.source_size, t.target,
      sum(d.size) OVER (PARTITION BY t.source_id ORDER BY d.digest) AS queued
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
u AS (SELECT *, (turn * source_size + queued)::double / target AS finish
      FROM q CROSS JOIN (SELECT unnest([0, 1, 2]) AS turn) WHERE size > 0 AND target > 0),
m AS (SELECT *, sum(size) OVER (ORDER BY finish, source_id, turn, digest ROWS UNBOUNDED PRECEDING) AS passed FROM u),
p AS (SELECT doc_id, count(*) AS passes FROM m WHERE passed <= (SELECT sum(size) FROM d) GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, (coalesce(p.passes, 0) * q.size)::bigint AS taken
FROM q LEFT JOIN p USING (doc_id)""")
def op4_mix_sources(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


_KNOWN = "MAP {" + ", ".join(f"'{t}': '{i}'" for i, t in licenses.SENTENCES.items()) + "}"
_CUT = "chr(10) || lower(text) || chr(10)"
for _pattern, _replacement in licenses.NORMALISE:
    _CUT = f"regexp_replace({_CUT}, '{_pattern}', '{_replacement.replace('$', chr(92))}', 'g')"
_BY_RULE = {k: "MAP {" + ", ".join(f"'{q}': '{v}'" for q, v in {
    licenses.sequence_of(r[0]): r[k] for r in reversed(licenses.RULES)}.items()) + "}" for k in (1, 2)}
_FAMILY = " ".join(f"WHEN list_contains(families, '{f}') THEN '{f}'" for f in licenses.FAMILIES)


@query(f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
c AS (SELECT doc_id, list_transform(regexp_extract_all({_CUT}, '{licenses.SENTENCE}', 1), lambda x: {_KNOWN}[replace(x, chr(10) || chr(10), ' ')]) AS ids FROM d),
q AS (SELECT doc_id, ids, coalesce(array_to_string(list_transform(ids, lambda x: '<' || x || '>'), ''), '') AS sentences FROM c),
m AS (SELECT *, regexp_extract_all(sentences, '{"|".join(licenses.sequence_of(r[0]) for r in licenses.RULES)}') AS matched FROM q),
f AS (SELECT *, list_transform(matched, lambda x: {_BY_RULE[1]}[x]) AS names, list_transform(matched, lambda x: {_BY_RULE[2]}[x]) AS families FROM m)
SELECT doc_id, coalesce(array_to_string(list_filter(names, lambda x, k: list_position(names, x) = k), ', '), '') AS licences,
  CASE {_FAMILY} ELSE 'none' END AS family, len(ids) AS n_sentences, sentences FROM f""")
def op5_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query()
def op6_pii_pseudonyms(spark, sf_dir):
    return pii.pseudonyms(table(spark, sf_dir, "documents"))


@query()
def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.train(docs)).select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score", "ambiguous")


@query()
def op9_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query()
def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


@query()
def op2_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op8_spot_signatures(spark, sf_dir):
    return spotsigs.fingerprints(table(spark, sf_dir, "documents"))


def _sql_rounds() -> str:
    """The rounds of the clustering, one table of distances and one of centroids each."""
    steps = []
    for k in range(centroids.ROUNDS + 1):
        steps.append(f"""
d{k} AS MATERIALIZED (SELECT v.row, c.cluster, sum((v.x - c.x) * (v.x - c.x))::bigint AS distance
  FROM v JOIN c{k} c ON v.dim = c.dim GROUP BY v.row, c.cluster),
a{k} AS MATERIALIZED (SELECT row, cluster, distance FROM d{k}
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, cluster) = 1)""")
        if k < centroids.ROUNDS:
            steps.append(f"""
m{k} AS (SELECT a.cluster, v.dim, floor_div(sum(v.x)::bigint, count(*)) AS x FROM a{k} a JOIN v USING (row) GROUP BY a.cluster, v.dim),
c{k + 1} AS MATERIALIZED (SELECT c.cluster, c.dim, coalesce(m.x, c.x) AS x FROM c{k} c LEFT JOIN m{k} m ON c.cluster = m.cluster AND c.dim = m.dim)""")
    # Whole division rounds towards zero; the contract's floor does not.
    return ",".join(steps).replace("floor_div(sum(v.x)::bigint, count(*))",
                                   "(sum(v.x)::bigint - ((sum(v.x)::bigint % count(*)) + count(*)) % count(*)) // count(*)")


@query(f"""
WITH e AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor({centroids.SCALE} * x::double)) AS xs FROM embeddings
  WHERE len(embedding) = {centroids.COMPONENTS}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {centroids.COMPONENTS}),
v AS MATERIALIZED (SELECT row, generate_subscripts(xs, 1) AS dim, unnest(xs)::bigint AS x FROM e),
s AS (SELECT row, row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || vec_id::varchar)) - 1 AS cluster FROM e
  QUALIFY cluster < {centroids.CENTROIDS}),
c0 AS MATERIALIZED (SELECT s.cluster, v.dim, v.x FROM s JOIN v USING (row)),{_sql_rounds()},
h AS (SELECT cluster, sha256(string_agg(x::varchar, ',' ORDER BY dim)) AS centroid_sha256 FROM c{centroids.ROUNDS} GROUP BY cluster)
SELECT e.vec_id, a.cluster::int AS cluster, a.distance, (sum(a.distance) OVER (PARTITION BY a.cluster))::bigint AS cluster_inertia,
  (sum(a.distance) OVER ())::bigint AS inertia, h.centroid_sha256
FROM a{centroids.ROUNDS} a JOIN e USING (row) JOIN h USING (cluster)""")
def op11_centroid_clusters(spark, sf_dir):
    return centroids.report(*centroids.cluster(table(spark, sf_dir, "embeddings")))


@query()
def op12_tokenizer_alignment(spark, sf_dir):
    return alignment.align(table(spark, sf_dir, "documents"))


@query()
def op13_token_files(spark, sf_dir):
    return token_files.read(token_files.write(table(spark, sf_dir, "documents")))


@query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
