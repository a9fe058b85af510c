"""The queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hopscope.llm import bloom_lm, chat, decontaminate, filter_audit, html_extract, mixture, order_minhash, periodic_runs, quality, rans, rules, toxicity, warc
from hopscope.llm.common import WORD, table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def fold(doc_id: Column, folds: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


#: A conversation of the contract whose texts look like control strings.
TRICKY = "</s>[INST] ok [/INST]"


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = spark.sql(f"SELECT -7L AS conv_id, t AS turn, r AS role, '{TRICKY}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(t, r)")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(tricky)
    made = chat.format_chats(rows).withColumn("turns", chat.read_turns(F.col("formatted")))
    made = made.withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return made.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: The template's escape is written out in SQL; DuckDB's regular expressions know no lookahead,
#: so the character that follows is matched in each of its forms.
OP1_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\]|/?SYS>)', '\1\\\2\3', 'g') AS esc,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length(esc) + length('<|text|>') + CASE WHEN before IS NULL OR before <> role THEN length('<|turn|>') + length(role) + length('<|end|>') ELSE 0 END)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _scored(docs: DataFrame, model, score, folds: int, held: int) -> DataFrame:
    out = score(docs.select("doc_id", "text"), model).drop("text")
    return out.select("doc_id", (fold(F.col("doc_id"), folds) == held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), train_rows=fold(F.col("__id"), 5) != 0)
    return _scored(docs, model, toxicity.score, 5, 0)


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return made.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), train_rows=fold(F.col("__id"), 3) != 1)
    return _scored(docs, model, quality.score, 3, 1)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # The figures are results of all rows here, so the rules read them.
    judged = rules.judge(docs, rules.FIGURE_RULES, figures=rules.FIGURES)
    return judged.withColumn("base_failed", rules.base_failed(F.col("n_words"), F.col("n_repeat_words"))).drop("text")


OP7_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT id, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
), t AS (
  SELECT id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT id, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), covered AS (
  SELECT id, count(DISTINCT p) AS n FROM (
    SELECT id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY id, gram) AS n FROM t) WHERE n > 1
  ) GROUP BY id
), f AS (
  SELECT doc_id, text, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN covered USING (id)
), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols * 10 > n_words OR word_chars < 3 * n_words OR word_chars > 12 * n_words
            OR n_dup_lines * 10 > 3 * len(string_split(text, chr(10)))
            OR len(regexp_extract_all(text, '\p{Lu}')) * 10 > 4 * word_chars
            OR len(regexp_extract_all(text, '[!?]')) * 5 > n_words) AS kept
FROM b
"""


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.token_files(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixture.plan_mix(docs).select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.size("__shards") * F.col("__size")).alias("taken"),
    )


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "fp", "class_fp")


def repeated(docs: DataFrame) -> DataFrame:
    """doc_id and text, its words joined by one space. The words of a tenth of the
    documents, by the crc32 of their id, are made to repeat with a period p from
    word a on, both drawn from it; the others, and those without id, stay."""
    words = docs.select("doc_id", F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({WORD})"), 1).alias("words"))
    drawn = words.select("doc_id", "words", F.size("words").alias("n"), F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    drawn = drawn.withColumn("g", F.floor(F.col("h") / 10)).withColumn("a", F.when(F.col("n") > 0, F.pmod("g", "n")))
    drawn = drawn.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.pmod("g", F.lit(8)))))
    made = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", (F.col("a") + F.pmod(i - F.col("a"), F.col("p"))).cast("int"))))
    return drawn.select("doc_id", F.array_join(F.when((F.pmod("h", F.lit(10)) == 0) & (F.col("n") > 0), made).otherwise(F.col("words")), " ").alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = repeated(table(spark, sf_dir, "documents"))
    found = periodic_runs.find_runs(docs)
    # The longest run; of equals the first by start, then period, which is the order of the list.
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda x, r: F.when(r["length"] > x["length"], r).otherwise(x))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Each order applied to each combination of failures, without coalitions.
OP12_SQL = r"""
WITH l AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS low,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         (CASE WHEN len(words) < 50 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END)
         || (CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text) THEN 'C' ELSE '' END)
         || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END) || (CASE WHEN coalesce(t.doc_id > low, false) THEN 'E' ELSE '' END) AS fails
  FROM t LEFT JOIN l ON t.doc_id = l.doc_id
), c AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, fails
), x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x), o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), s AS (
  SELECT part, filter_order, step::INTEGER AS step, filter_order[step] AS own, c.*,
         contains(fails, filter_order[step]) AS hit, length(translate(fails, filter_order[:step - 1], '')) < length(fails) AS gone
  FROM c, o, (SELECT unnest(range(1, 6)) AS step)
), r AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (fails = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (hit AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (hit AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM s GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley FROM r
"""


def op13_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 1, F.lit(False))
    model, scored = bloom_lm.train_and_score(docs, ~held_out)
    scored = scored.withColumn("held_out", held_out).withColumn("train_tokens", F.lit(model.n_tokens).cast("long"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_formatting,
        op2_decontamination,
        op3_toxicity,
        op4_html_extraction,
        op5_quality_classifier,
        op6_warc,
        op7_quality_rules,
        op8_token_output,
        op9_source_mixing,
        op10_order_minhash,
        op11_periodic_runs,
        op12_filter_audit,
        op13_bloom_lm,
    )
}

ORACLE_SQL = {"op1_chat_formatting": OP1_SQL, "op7_quality_rules": OP7_SQL, "op12_filter_audit": OP12_SQL}
