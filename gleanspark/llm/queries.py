"""One registered query per operator: production parameters, whole tables, full results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.llm import (
    chat_format,
    decontaminate,
    exact_dedup,
    langid,
    line_dedup,
    mixing,
    near_dedup,
    spelling,
    suffix_dedup,
    token_counts,
    token_files,
    toxicity,
    whitening,
)
from gleanspark.llm.common import held_fold, scratch, table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item it leaks."""
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "item_words", "covered_words", "coverage",
                        F.size("tiles").cast("long").alias("n_tiles"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents"), passage_words=50)
    return out.select("doc_id", "n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines",
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents")).drop("spans")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = held_fold(F.col("doc_id"), 5) == 0
    log_p = toxicity.language_model(docs)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~held), log_p)
    return toxicity.score(docs, log_p, model).select(
        "doc_id", held.alias("held_out"), "score", "predicted", "n_marks")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"), percent=85)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = held_fold(F.col("doc_id"), 3) == 1
    dictionaries = langid.fit(docs, learn=~held)
    return langid.identify(docs, dictionaries).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score", "margin", "accepted")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_counts.count_tokens(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = mixing.mix(table(spark, sf_dir, "documents"))
    return (pieces.groupBy("doc_id", "size", "source_size", "target")
            .agg(F.sum("n_words").alias("taken")))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), digest_all=True)


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)],
                                  "conv_id long, turn long, role string, text string")
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chat_format.format_chats(chats.unionByName(extra))
    read = formatted.select("conv_id", "formatted", "n_messages",
                            chat_format.read_back(F.col("formatted")).alias("turns"),
                            chat_format.loss_text(F.col("segments")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "n_messages")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model, error = whitening.whiten(table(spark, sf_dir, "embeddings"))
    shares = [] if model is None else [float(e / model.trace) if model.trace else 0.0 for e in model.eigenvalues]
    explained = F.array(*[F.lit(s) for s in shares]) if shares else F.array().cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened")).select(
        "vec_id", (F.col("_at") + 1).alias("component"), F.lit(0 if model is None else model.n).cast("long").alias("n"),
        F.col("deviation").cast("long").alias("deviation"), "whitened",
        F.get(explained, F.col("_at")).alias("explained"), F.lit(error).alias("identity_error"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents")))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = scratch(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", token_files.ids_crc32(F.col("ids")).alias("ids_crc32"))


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_line_dedup, op3_suffix_dedup, op4_toxicity, op5_near_dedup, op6_language_id, op7_token_counts, op8_mixing,
                                   op9_exact_dedup, op10_chat_format, op11_whitening, op12_spelling,
                                   op13_token_files)}

_BLANK = r"[\x20\x09-\x0D]+"
_TAILS = "|".join("".join("\\" + c if c in "|[]/" else c for c in t).replace(r"\/", "/")
                  for t in chat_format.CONTROL)


def _escaped(col: str) -> str:
    return rf"regexp_replace({col}, '([<\[])(\\*)({_TAILS})', '\1\\\2\3', 'g')"


ORACLE = {
    "op9_exact_dedup": f"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{_BLANK}', ' ', 'g') AS norm
           FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept,
       sha256(t.norm) AS text_sha256
FROM t JOIN g ON t.norm = g.norm""",
    "op10_chat_format": f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
w AS (SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) <> role, true)
             AS opens FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text))
    AS loss_sha256,
  CAST(sum(length({_escaped('text')})
      + CASE WHEN opens THEN 12 + length({_escaped('role')}) + 1 + 11 ELSE 10 END) AS BIGINT)
    AS formatted_chars,
  CAST(sum(CASE WHEN opens THEN 1 ELSE 0 END) AS BIGINT) AS n_messages
FROM w GROUP BY conv_id""",
    "op12_spelling": r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
           list_concat([i::UBIGINT], list_transform(range(8), lambda k: 0::UBIGINT)),
           lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]{6,}')) AS run FROM documents)
  GROUP BY ALL),
bytes AS (
  SELECT run, k, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c:
           CASE WHEN unicode(c) < 128 THEN [unicode(c)::UBIGINT]
                ELSE [192::UBIGINT + unicode(c) // 64, 128::UBIGINT + unicode(c) % 64] END)) AS b
  FROM runs),
hashed AS (
  SELECT run, k, xor(list_reduce(list_concat([4294967295::UBIGINT], b),
           lambda c, x: xor(c >> 8, t[1 + (xor(c, x) % 256)::INT])), 4294967295::UBIGINT) AS h
  FROM bytes, crc),
words AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
              ELSE run END AS word, k FROM hashed),
v AS (SELECT word, sum(k)::BIGINT AS n FROM words WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
less AS (
  SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS l
  FROM (SELECT word, unnest(range(1, length(word) + 1))::INT AS i FROM v)),
links AS (
  SELECT a.word, b.word AS near FROM less a JOIN less b ON a.l = b.l AND a.i = b.i WHERE a.word <> b.word
  UNION SELECT a.word, v.word FROM less a JOIN v ON a.l = v.word
  UNION SELECT v.word, a.word FROM less a JOIN v ON a.l = v.word),
best AS (
  SELECT links.word, count(*) AS n_near, first(near ORDER BY v.n DESC, near) AS near, max(v.n) AS m
  FROM links JOIN v ON v.word = links.near GROUP BY links.word),
f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * v.n THEN near END AS form,
         CASE WHEN m >= 5 * v.n THEN m END AS form_n
  FROM v LEFT JOIN best ON v.word = best.word),
chain AS (
  SELECT word, coalesce(form, word) AS root FROM f
  UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.root WHERE f.form IS NOT NULL),
ends AS (SELECT chain.word, chain.root FROM chain JOIN f ON f.word = chain.root WHERE f.form IS NULL)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, ends.root FROM f JOIN ends ON f.word = ends.word""",
}
