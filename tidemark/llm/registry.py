"""Queries of the training-data operators over the given tables, with production parameters and whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fold, scratch_path, table


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import sentencepiece_codec as sp

    return sp.codec_report(table(spark, sf_dir, "documents"), sp.default_path())


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import html_extract as h

    return h.extract_pages(table(spark, sf_dir, "pages"), h.default_model())


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import toxicity as t

    docs = table(spark, sf_dir, "documents")
    model = t.fit(docs, table(spark, sf_dir, "labels"), held_mod=5, held_at=0)
    return t.score_documents(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op4_chroma_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import audio

    return audio.count_links(audio.text_recordings(table(spark, sf_dir, "documents")), held=audio.HELD)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import quality as q

    docs = table(spark, sf_dir, "documents")
    model = q.fit(docs, table(spark, sf_dir, "labels"), held_mod=4, held_at=2)
    return q.score_documents(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import language as g

    docs = table(spark, sf_dir, "documents")
    found = g.identify(docs, g.fit(docs, held_mod=5, held_at=0))
    return found.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import packing as p
    from tidemark.llm.token_encoder import default_path

    return p.pack_documents(table(spark, sf_dir, "documents"), default_path())


def op8_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import token_orc as o
    from tidemark.llm.token_encoder import default_path

    path = scratch_path(spark, "token-orc")
    o.write_token_orc(table(spark, sf_dir, "documents"), path, default_path())
    return o.positions(o.read_token_orc(spark, path))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import fingerprint as f

    return f.edited_likeness(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import simhash as s

    return s.near_duplicates(table(spark, sf_dir, "documents"))


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import chat
    from tidemark.llm.token_encoder import default_path

    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = f"{chat.END}{chat.START}assistant ok"
    one_more = spark.createDataFrame([(-1, 0, "user", trap), (-1, 1, "assistant", trap)], "conv_id long, turn long, role string, text string")
    return chat.formatted_digests(given.union(one_more), default_path())


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import centroids

    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import phrases

    return phrases.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_sentencepiece, op2_html_text, op3_toxicity, op4_chroma_fingerprints, op5_quality, op6_language, op7_packing, op8_token_orc, op9_fingerprints, op10_simhash, op11_chat, op12_centroids, op13_phrases, pipeline]
    return {f.__name__: f for f in found}


def centroids_sql(k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """All distances of every round, compared plainly."""
    apart = "list_sum(list_transform(range(1, {dim} + 1), lambda i: (v.v[i] - c.v[i]) * (v.v[i] - c.v[i])))".format(dim=dim)
    steps = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim})""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS cluster, v
  FROM (SELECT sha256('{seed}:' || CAST(vec_id AS VARCHAR)) AS h, v FROM kept ORDER BY h NULLS LAST, v LIMIT {k}))""",
    ]
    for i in range(rounds + 1):
        steps.append(f"a{i} AS MATERIALIZED (SELECT v.id, min(CAST({apart} AS HUGEINT) * {k} + c.cluster) AS m FROM kept v, c{i} c GROUP BY v.id)")
        if i < rounds:
            steps.append(
                f"""m{i} AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY d) AS v FROM
  (SELECT m % {k} AS cluster, d, CAST(sum(v[d]) AS HUGEINT) AS s, count(*) AS n FROM a{i} JOIN kept USING (id), range(1, {dim + 1}) AS r(d) GROUP BY ALL) GROUP BY cluster)"""
            )
            steps.append(f"c{i + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m USING (cluster))")
    return (
        "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(m % {k} AS INTEGER) AS cluster, CAST(m // {k} AS BIGINT) AS distance, CAST(sum(m // {k}) OVER (PARTITION BY m % {k}) AS BIGINT) AS cluster_inertia,
  CAST(sum(m // {k}) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (id) JOIN c{rounds} c ON c.cluster = m % {k}"""
    )


def phrases_sql(min_count: int = 100, top: int = 2000) -> str:
    """Every phrase of one to five words counted where it stands."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\n\x0B\f\r]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM words, range(1, 6) AS r(k)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY 1),
often AS MATERIALIZED (SELECT * FROM f WHERE f >= {min_count}),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM often WHERE k > 1),
kept AS (SELECT * FROM cand c WHERE NOT EXISTS (SELECT 1 FROM cand d WHERE d.lang = c.lang AND d.k > c.k AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' ') AND 100 * d.a >= 100 * c.a)),
cuts AS (SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS x, array_to_string(w[cut + 1:], ' ') AS y FROM kept, range(1, 5) AS r(cut) WHERE cut < k),
scored AS (SELECT c.lang, phrase, a, cut, x.f AS l, y.f AS r, n, CAST(1000::HUGEINT * a * n // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts c JOIN total USING (lang) JOIN (SELECT lang, phrase AS x, f FROM often) x USING (lang, x) JOIN (SELECT lang, phrase AS y, f FROM often) y USING (lang, y)),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM lowest)
SELECT * FROM ranked WHERE rank <= {top}"""


def oracle_sql() -> dict[str, str]:
    """The other results cannot be written in SQL (models, tokenizers, XXH64 and SHAKE hashes); tests check them by brute force."""
    return {"op12_centroids": centroids_sql(), "op13_phrases": phrases_sql()}
