"""The operators over the test tables, one query each, and their SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontam, fim, langid, mix, pages, parity, pivots, quality, rules, suffix, warc
from .common import bit_table, in_table, materialise, table

VOCABULARY = "byte_bpe_50k.json"
PROBE = "<|im_end|><|im_start|>assistant ok"


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    log = rows.unionByName(probe).withColumns({"seq": F.lit(0), "kind": F.lit("message")})
    rendered = chat.render(chat.fold_events(log))
    read = rendered.select(
        "conv_id",
        "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_masked(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    told = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP1_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
ordered AS (
  SELECT conv_id, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS told,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    count(*) AS n_turns,
    sum(length('<|im_start|>' || role || chr(10) || regexp_replace(text, '<(\\\\*)\\|', '<\\1\\\\|', 'g')
      || '<|im_end|>' || chr(10))) AS formatted_chars
  FROM rows GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM ordered
"""


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, by profiles learned from two thirds of them."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3
    held_out = documents.withColumn("held_out", fold == 1)
    profiles = langid.train(held_out.filter(~F.col("held_out")))
    return langid.predict(held_out.drop("lang"), profiles).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


def op3_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeats of 100 bytes."""
    cut = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"]
    )
    return cut.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    found = pages.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the component of near duplicates they belong to."""
    return parity.near_duplicates(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH RECURSIVE spoken AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM spoken WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.r = links.a)
SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(r) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives in the shared folder and read back."""
    records = table(spark, sf_dir, "pages").select("page_id", "url", F.col("html").alias("payload"))
    archives = materialise(warc.write_archives(warc.choose_types(records)))
    return warc.read_archives(archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP6_SQL = """
WITH digests AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hex
  FROM pages),
last AS (SELECT hex, max(page_id) AS last_id FROM digests GROUP BY hex)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST('0x' || substr(hex, CAST((i // 4) * 5 + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31) + 1 AS INT), 1)), '')
    AS payload_digest,
  CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last_id THEN last_id END AS refers_to
FROM digests JOIN last USING (hex)
"""


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The probability that each document is of quality, and that it is toxic.

    Sites are the sources of documents, their paths the languages there.
    """
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = (
        table(spark, sf_dir, "labels")
        .groupBy("doc_id")
        .agg(F.max("quality").alias("label_quality"), F.max("toxic").alias("label_toxic"))
    )
    # The one time that texts are shuffled: those with labels, stored for all that fitting reads.
    asked = in_table(documents.select("doc_id", "text"), "doc_id", bit_table(labels, "doc_id"))
    labelled = materialise(
        asked.join(labels.hint("merge"), "doc_id").select(
            "doc_id", "text", F.col("label_quality").alias("quality"), F.col("label_toxic").alias("toxic")
        )
    )
    targets = ("quality", "toxic")
    models = quality.fit(labelled, targets)
    scored = materialise(quality.evidence(documents, models).drop("text"))
    judged = scored.withColumnsRenamed({"source": "host", "lang": "path"}).join(labels, "doc_id", "left")
    for target in targets:
        judged = quality.posteriors(judged, target, quality.rate_of(labels, f"label_{target}"))
    return judged.select(
        "doc_id",
        "quality",
        "toxic",
        ((F.col("quality") >= 0.5) & (F.col("toxic") < 0.5)).alias("kept"),
    )


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with a byte-level vocabulary, and decoded again."""
    path = public_tokenizers.path(VOCABULARY)
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(documents, path).drop("text")
    return bpe.decode(ids, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and robust outliers of all documents."""
    return rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "distance",
    )


def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with passages of benchmark items, and the items."""
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut for fill-in-middle, and put together again."""
    cut = fim.rearrange(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id",
        F.col("n_units").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP11_SQL = """
WITH told AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex
  FROM documents),
units AS (
  SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS u,
    [CAST('0x' || hex[1 + 8 * i : 8 + 8 * i] AS BIGINT) FOR i IN range(4)] AS h FROM told),
cuts AS (
  SELECT *, len(u) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a,
    greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90
      THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM units),
parts AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
    array_to_string(u[b + 1:n], '') AS s FROM cuts)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""


def op12_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much a mix of the sources takes of every document."""
    taken = mix.words_taken(mix.mix(table(spark, sf_dir, "documents")))
    return taken.withColumnRenamed("key", "doc_id")


def op13_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding's cluster, after three rounds."""
    found = pivots.with_inertia(pivots.cluster(table(spark, sf_dir, "embeddings")))
    return found.withColumnRenamed("key", "vec_id")


def _op13_sql() -> str:
    """The rounds written out one after the other."""
    nearest = """
    SELECT vec_id, h, v, cluster, distance FROM (
      SELECT x.vec_id, x.h, x.v, c.cluster, list_sum([CAST((x.v[i] - c.v[i]) * (x.v[i] - c.v[i]) AS BIGINT)
          FOR i IN range(1, 65)]) AS distance
      FROM whole x, {centroids} c)
    QUALIFY row_number() OVER (PARTITION BY h, v, vec_id ORDER BY distance, cluster) = 1"""
    parts = [
        """
  whole AS (
    SELECT vec_id, sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h,
      [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings WHERE len(embedding) = 64
      AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)""",
        """
  c0 AS (
    SELECT row_number() OVER (ORDER BY h, v) - 1 AS cluster, v FROM (SELECT h, v FROM whole ORDER BY h, v LIMIT 16))""",
    ]
    for i in range(pivots.ROUNDS):
        parts.append(f"\n  a{i} AS ({nearest.format(centroids=f'c{i}')})")
        parts.append(f"""
  c{i + 1} AS (
    SELECT c{i}.cluster, coalesce(moved.v, c{i}.v) AS v FROM c{i} LEFT JOIN (
      SELECT cluster, list(m ORDER BY j) AS v FROM (
        SELECT cluster, j, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
        FROM (SELECT cluster, unnest(v) AS x, unnest(range(64)) AS j FROM a{i}) GROUP BY cluster, j)
      GROUP BY cluster) moved USING (cluster))""")
    last = f"c{pivots.ROUNDS}"
    parts.append(f"\n  final AS ({nearest.format(centroids=last)})")
    return f"""WITH {",".join(parts)}
SELECT vec_id, CAST(final.cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY final.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string({last}.v, ',')) AS centroid_sha256
FROM final JOIN {last} ON final.cluster = {last}.cluster
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat": op1_chat,
    "op2_langid": op2_langid,
    "op3_suffix": op3_suffix,
    "op4_pages": op4_pages,
    "op5_parity": op5_parity,
    "op6_warc": op6_warc,
    "op7_quality": op7_quality,
    "op8_bpe": op8_bpe,
    "op9_rules": op9_rules,
    "op10_decontam": op10_decontam,
    "op11_fim": op11_fim,
    "op12_mix": op12_mix,
    "op13_pivots": op13_pivots,
}
ORACLES: dict[str, str] = {
    "op1_chat": OP1_SQL,
    "op5_parity": OP5_SQL,
    "op6_warc": OP6_SQL,
    "op11_fim": OP11_SQL,
    "op13_pivots": _op13_sql(),
}
