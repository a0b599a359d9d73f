"""The registered ``opN_*`` queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotalake.llm import common as C
from quotalake.llm import (
    backoff,
    conversations,
    decontaminate,
    fim,
    langid,
    licenses,
    linededup,
    packing,
    pii,
    quality,
    sharding,
    simhash,
    warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def default_tokenizer() -> str:
    """The vocabulary file of the packing query; it is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality(docs, _table(spark, sf_dir, "labels")).drop("text")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op3_language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op4_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_private(_table(spark, sf_dir, "documents"))

    def joined(places, kind: str):
        return F.concat_ws(",", F.transform(places, lambda p: F.concat_ws(":", F.lit(kind), p["start"], p["stop"])))

    counts = {k: F.expr(f"size(filter(spans, s -> s.kind = '{k}'))").cast("long") for k in (*pii.KINDS, pii.SECRET)}
    secrets = joined(F.filter("spans", lambda s: s["kind"] == pii.SECRET), pii.SECRET)
    parts = [F.when(c != "", c) for c in (F.col("base"), secrets, joined("terms", pii.TERM))]
    terms = F.size("terms").cast("long")
    return found.select("doc_id", *[counts[k].alias(f"n_{k}") for k in pii.KINDS], F.sha2("base", 256).alias("base_sha256"),
                        F.concat_ws(",", *parts).alias("spans"), counts[pii.SECRET].alias("n_secret"), terms.alias("n_term"),
                        (F.size("spans").cast("long") + terms).alias("n_private"))


def op5_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    # rounded, as the order in which logarithms are added up shows in a sum's last digits
    return backoff.score(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"))


def op6_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_by_bytes(_table(spark, sf_dir, "documents"), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    done = linededup.dedup_lines(docs.withColumn("n_lines", F.size(F.split(F.coalesce("text", F.lit("")), "\n"))))
    return done.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"),
                       F.col("removed_lines").cast("long").alias("removed_lines"),
                       F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
                       F.array_join(F.transform("kept_in", lambda d: d.cast("string")), ",").alias("class_docs"), "line_links")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op9_concat_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), default_tokenizer())
    return pieces.drop("ids")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    places = F.flatten("base_places")
    return found.select("doc_id", "n_words", F.size(places).cast("long").alias("n_base"),
                        F.array_min(places).cast("long").alias("first_word"),
                        F.array_max(places).cast("long").alias("last_word"),
                        F.concat_ws(",", "base_labels").alias("base_labels"),
                        F.concat_ws(",", "labels").alias("labels"), "score")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    path = C.scratch_path(spark)
    warc.write(pages, path)
    records = warc.read(spark, path, payloads=False)
    kind = pages.schema["page_id"].dataType
    sound = F.when(F.col("problem").isNull(), F.col("record_type")).otherwise(F.raise_error(F.col("problem")))
    return records.select(F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest",
                          sound.alias("record_type"), F.col("refers_to").cast(kind).alias("refers_to"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fim.restore(fim.transform(_table(spark, sf_dir, "documents")))
    return done.select("doc_id", F.col("n_lines").alias("n"), "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(_table(spark, sf_dir, "conversations")), "absent")


_ALL = [op1_quality_rules, op2_decontaminate, op3_language_profiles, op4_private_data, op5_stupid_backoff,
        op6_histogram_shards, op7_line_dedup, op8_simhash, op9_concat_and_cut,
        op10_license_scan, op11_warc, op12_fill_in_middle,
        op13_conversation_repair]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Registered name -> query; each first sends the package to the executors."""

    def ready(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            C.ship_code(spark)
            return fn(spark, sf_dir)
        return run

    return {fn.__name__: ready(fn) for fn in _ALL}


_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

#: DuckDB SQL of the queries that SQL can express, over words as text: every window of every text (2), every
#: occurrence of every n-gram with its counts in the corpus and in its own document (5).
ORACLE_SQL: dict[str, str] = {
    "op2_decontaminate": f"""
        WITH doc AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
        item AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
        win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n,
                       array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
                FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0)),
        docwin AS (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
                   FROM (SELECT rid, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i
                         FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
        hit AS (SELECT rid, i, n, win FROM docwin SEMI JOIN win USING (n, win)),
        cover AS (SELECT rid, count(DISTINCT p) AS n_hit
                  FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
        found AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
                  FROM (SELECT DISTINCT h.rid, CAST(win.item_id AS VARCHAR) AS id
                        FROM (SELECT DISTINCT rid, n, win FROM hit) h JOIN win USING (n, win)) GROUP BY rid)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc LEFT JOIN cover USING (rid) LEFT JOIN found USING (rid)""",
    "op5_stupid_backoff": f"""
        WITH doc AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
        word AS (SELECT rid, i, len(w) AS n, w[i] AS c, CASE WHEN i > 1 THEN w[i - 1] END AS b,
                        CASE WHEN i > 2 THEN w[i - 2] END AS a
                 FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM doc)),
        known AS (SELECT rid, i, greatest(count(*) OVER () - n, 1) AS outside,
                         count(*) OVER (PARTITION BY c) - count(*) OVER (PARTITION BY rid, c) AS k1,
                         count(*) OVER (PARTITION BY b, c) - count(*) OVER (PARTITION BY rid, b, c) AS k2,
                         count(*) OVER (PARTITION BY a, b, c) - count(*) OVER (PARTITION BY rid, a, b, c) AS k3
                  FROM word),
        context AS (SELECT *, lag(k1) OVER (PARTITION BY rid ORDER BY i) AS before1,
                           lag(k2) OVER (PARTITION BY rid ORDER BY i) AS before2 FROM known),
        scored AS (SELECT rid, sum(CASE WHEN i > 2 AND k3 > 0 THEN ln(k3 / before2)
                                        WHEN i > 1 AND k2 > 0 THEN ln(k2 / before1) + ln(0.4)
                                        WHEN k1 > 0 THEN ln(k1 / outside) + 2 * ln(0.4)
                                        ELSE 3 * ln(0.4) - ln(outside) END) AS s
                   FROM context GROUP BY rid)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, round(coalesce(s, 0.0), 4) AS log_score,
               CASE WHEN len(w) > 0 THEN round(s / len(w), 6) END AS mean_log_score
        FROM doc LEFT JOIN scored USING (rid)""",
    "op11_warc": """
        WITH page AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        seen AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS keep FROM page),
        typed AS (SELECT *, strlen(h) >= 1000 AND keep IS NOT NULL AND page_id IS DISTINCT FROM keep AS again FROM seen)
        SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
               CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN again THEN keep END AS refers_to
        FROM typed""",
    "op12_fill_in_middle": r"""
        WITH doc AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
                            regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
                            sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
        drawn AS (SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS x,
                         CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS y,
                         t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') AS plain,
                         CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 AS spm FROM doc),
        cut AS (SELECT *, array_to_string(u[1:least(x, y)], '') AS p,
                       array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m,
                       array_to_string(u[greatest(x, y) + 1:], '') AS s FROM drawn)
        SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
               CASE WHEN NOT plain THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
               CASE WHEN NOT plain THEN CAST(length(m) AS BIGINT) END AS middle_chars,
               sha256(CASE WHEN plain THEN t WHEN spm THEN '<S>' || s || '<P>' || p || '<M>' || m
                           ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM cut""",
}
