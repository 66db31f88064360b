"""Registered queries of the operators, each over its whole table, and the SQL that checks them."""

from __future__ import annotations

from fractions import Fraction

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import chat_format, fim, language_id, mixing, ngram_join, packing, piece_fst, pii, quality_model, quality_rules, spelling, storage, vector_dedup, warc
from riskloom.llm.quality_model import in_fold


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = storage.fresh_path(spark, "warc")
    manifest = warc.write_warc(storage.table(spark, sf_dir, "pages"), folder)
    return warc.read_warc(manifest, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = piece_fst.decoded(piece_fst.encoded(storage.table(spark, sf_dir, "documents").select("doc_id", "text"), path), path)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return docs.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), same.alias("round_trip"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = storage.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.with_spans(docs, pii.fit(docs)).drop("text")
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.base AND s.kind = '{kind}')) AS LONG)").alias(f"n_{kind}") for kind in pii.KINDS]
    counts += [F.expr("CAST(size(filter(spans, s -> s.kind = 'secret')) AS LONG)").alias("n_secret"), F.size("spans").cast("long").alias("n_spans")]
    return found.select("doc_id", *counts, F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = storage.table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = storage.table(spark, sf_dir, "documents")
    return ngram_join.ngram_components(docs, n=3, threshold=Fraction(9, 10))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = storage.table(spark, sf_dir, "documents")
    model = language_id.fit(docs, ~in_fold(4, 2))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", in_fold(4, 2).alias("held_out"), "language.lang_pred", "language.score")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = storage.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "\\### Assistant: </turn> ok"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    rows = one.union(more)
    # A turn is a record in one of three layouts, by its conversation: the fingerprint has to tell them apart.
    layouts = [F.struct("role", "text"), F.struct(F.array(F.struct("role", F.col("text").alias("content"))).alias("messages")), F.struct(F.array(F.struct(F.col("role").alias("from"), F.col("text").alias("value"))).alias("conversations"))]
    asked, (first, second, third) = F.pmod("conv_id", F.lit(3)), [F.to_json(x, {"ignoreNullFields": "false"}) for x in layouts]
    records = rows.select("conv_id", "turn", F.when(asked == 1, second).when(asked == 2, third).otherwise(first).alias("record"))
    rows = chat_format.read_chats(chat_format.format_chats(records))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(text.cast("binary"), 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(storage.table(spark, sf_dir, "documents"))


def op9_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(storage.table(spark, sf_dir, "embeddings"))


def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = storage.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model.fit(docs, storage.table(spark, sf_dir, "labels"), ~in_fold(5, 0))
    scored = quality_model.score_quality(docs, model)
    predicted = F.when(F.col("quality_score") >= 0.3, 1).otherwise(0).cast("int")
    return scored.select("doc_id", in_fold(5, 0).alias("held_out"), F.col("quality_score").alias("score"), predicted.alias("predicted"))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fim.restored(fim.fill_in_middle(storage.table(spark, sf_dir, "documents"), seed=7, rate=100, spm=50))
    shown = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *shown)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spelling.vocabulary(storage.table(spark, sf_dir, "documents")))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(storage.table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


QUERIES = {f.__name__: f for f in (op1_warc, op2_pieces, op3_pii, op4_packing, op5_ngram_join, op6_language_id, op7_chat_format, op8_quality_rules, op9_vector_dedup, op10_quality_model, op11_fim, op12_spelling, op13_mixing)}
SQL = {
    "op1_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
f AS (SELECT page_id, encode(body) AS payload, sha1(encode(body)) AS digest, min(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes,
  (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(digest, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS INT), 1), '' ORDER BY i)
   FROM range(32) r(i)) AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to
FROM f""",
    "op7_chat_format": """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\\### Assistant: </turn> ok' FROM range(2) r(i)),
u AS (SELECT *, 14 + length(role) + length(regexp_replace(text, '[\\\\<#]', 'xx', 'g')) AS chars FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM u GROUP BY conv_id""",
    "op11_fim": """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u FROM documents),
e AS (
  SELECT *, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS c2,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
      WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
f AS (
  SELECT *, coalesce(array_to_string(u[1:least(c1, c2)], ''), '') AS p, coalesce(array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], ''), '') AS m,
    coalesce(array_to_string(u[greatest(c1, c2) + 1:], ''), '') AS s FROM e)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CAST(CASE WHEN form <> 'plain' THEN length(p) END AS BIGINT) AS prefix_chars,
  CAST(CASE WHEN form <> 'plain' THEN length(m) END AS BIGINT) AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM f""",
    "op12_spelling": """
WITH RECURSIVE bits(i, k, v) AS (
  SELECT i, 0, i FROM range(256) r(i) UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w FROM documents),
once AS (SELECT doc_id, w, count(*) AS c FROM runs WHERE length(w) >= 6 GROUP BY ALL),
hashed AS (
  SELECT w, c, CASE WHEN doc_id IS NOT NULL THEN xor(list_reduce(
    [4294967295] || flatten(list_transform(string_split(doc_id || ':' || w, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [195, unicode(x) - 64] END)),
    lambda h, b: xor(h // 256, t[1 + xor(h % 256, b)])), 4294967295) END AS h FROM once, crc),
words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, c FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
cuts AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM words, range(length(word)) r(i)),
pairs AS (
  SELECT a.word AS a, b.word AS b FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word FROM cuts a JOIN words b ON a.rest = b.word UNION SELECT b.word, a.word FROM cuts a JOIN words b ON a.rest = b.word),
near AS (
  SELECT a AS word, count(*) AS n_near, arg_min(b, (-w.n, encode(b))) AS best, max(w.n) AS best_n FROM pairs JOIN words w ON w.word = b GROUP BY a),
forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * words.n THEN best END AS form,
    CASE WHEN best_n >= 5 * words.n THEN best_n END AS form_n FROM words LEFT JOIN near USING (word)),
chain(word, last, next) AS (
  SELECT word, word, form FROM forms UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON c.next = f.word)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, c.last AS root FROM forms f JOIN chain c ON c.word = f.word AND c.next IS NULL""",
}
