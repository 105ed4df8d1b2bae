"""One query for each operator, over its whole table, and the SQL that checks some of them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm import (
    bpe,
    co_training,
    collocations,
    conversation_repair,
    cross_polytope,
    decontam,
    maglev,
    near_dup,
    quality_rules,
    samples,
    suffix_dedup,
    token_files,
    toxic_crf,
    warc,
)
from tradelake.llm.scratch import Scratch
from tradelake.llm.ship import ship_package

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

# The shards that documents are placed on.
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spans_size(spans: str) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["begin"]))


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    return bpe.decode(ids, RANKS, public_tokenizers.PATTERN).select(
        "row.doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = Scratch(spark, "warc").path("archives")
    warc.write_archives(table(spark, folder, "pages"), archives)
    return warc.read_archives(spark, archives, payloads=False).drop("payload", "url", "file")


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select(
        "row.doc_id",
        "n_bytes",
        spans_size("spans").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        (F.size("spans") > 0).alias("repeated"),
    )


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality_rules.apply_rules(docs).select("doc_id", *(f"quality.{n}" for n in names))


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontam.find_contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_co_training(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = co_training.fit_on(docs, table(spark, folder, "labels"))
    return co_training.score_quality(docs, model).select(
        F.col("id").alias("doc_id"),
        samples.held_out(F.col("id")).alias("held_out"),
        "score",
        "content_score",
        "metadata_score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        (F.col("score") >= 0.5).alias("kept"),
    )


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    files = Scratch(spark, "tokens").path("files")
    token_files.write_tokens(docs, files, TOKENIZER)
    return token_files.read_tokens(spark, files, docs, payloads=False).drop("ids")


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxic_crf.fit_on(docs, table(spark, folder, "labels"))
    return toxic_crf.score_toxicity(docs, model).select(
        F.col("id").alias("doc_id"),
        samples.held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "spans",
    )


def op9_maglev(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id")
    return maglev.place(docs, SHARDS)


def op10_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return near_dup.near_duplicates(docs, shingle=2).withColumnRenamed("id", "doc_id")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with some turns dropped, emptied, cut short, repeated or given to the user.

    Dropped turns stay as rows with `present` false, so that every conversation is known.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    way = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(way == 1, "").when(way == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(way == 4, "user").otherwise(space("role")).alias("role"),
        text.alias("text"),
        (way != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(1), F.when(way == 3, 2).otherwise(1))).alias("copy"),
    )


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = damaged(table(spark, folder, "conversations"))
    repaired = conversation_repair.repair_conversations(rows, present=F.col("present"))
    digests = conversation_repair.text_digests(repaired)
    return repaired.summary.join(digests, "conversation").select(
        F.col("conv").alias("conv_id"),
        *("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"),
        F.col("sha256").alias("repaired_sha256"),
    )


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine_phrases(table(spark, folder, "documents"))


def op13_cross_polytope(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return cross_polytope.nearest_neighbours(rows, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_bpe,
        op2_warc,
        op3_suffix_dedup,
        op4_quality_rules,
        op5_decontamination,
        op6_co_training,
        op7_token_files,
        op8_toxicity,
        op9_maglev,
        op10_near_dup,
        op11_conversation_repair,
        op12_collocations,
        op13_cross_polytope,
    )
}

_OP2_SQL = """
WITH p AS (
  SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first FROM p GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (payload_digest)"""

_OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 8, 2))) AS i
        FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM bw), dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), hit AS (SELECT doc_id, item_id, dw.n, i FROM dw JOIN bw USING (n, t)), words AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM hit, range(10) AS o(j) WHERE j < n GROUP BY 1
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY 1
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

_OP12_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, k, w[i:i + k - 1] AS g, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 5) AS s(k) WHERE len(w) >= k)
  GROUP BY lang, k, g HAVING count(*) >= 30
), cuts AS (
  SELECT c.lang, c.g, c.k, c.f AS a, j, x.f AS l, y.f AS r,
    CAST(CAST(2000000 AS HUGEINT) * c.f // (x.f + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM grams WHERE k > 1) c
  JOIN grams x ON x.lang = c.lang AND x.g = c.g[1:j] JOIN grams y ON y.lang = c.lang AND y.g = c.g[j + 1:]
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1
), inside AS (
  SELECT lang, g[i:i + m - 1] AS g, max(a) AS longer
  FROM (SELECT lang, g, a, k, m, unnest(range(1, k - m + 2)) AS i FROM best, range(2, 4) AS s(m) WHERE m < k)
  GROUP BY 1, 2
), ranked AS (
  SELECT b.lang, array_to_string(g, ' ') AS phrase, a, l, r, score,
    row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(array_to_string(g, ' '))) AS rank
  FROM best b LEFT JOIN inside USING (lang, g) WHERE longer IS NULL OR 100 * longer < 80 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""



def _repair_oracle() -> str:
    """The repair as a fold over each conversation's turns: the least way to each of four places in the grammar."""
    spaces = "[\\x20\\x09-\\x0D]"
    letter = "[^\\x20\\x09-\\x0D]"

    def way(before: str, cost: str, edit: str, line: str = "''") -> str:
        return (
            f"struct_pack(cost := {before}.cost + {cost}, audit := {before}.audit || '{edit}', "
            f"body := {before}.body || {line})"
        )

    def turn(role: str, initial: str, before: str, user: str) -> str:
        kept = f"CASE WHEN NOT r.go AND r.i = '{initial}' THEN 0 ELSE 1000000000 END + r.late"
        made = "CASE WHEN r.go THEN 1000000000 ELSE 1 END + r.late"
        return (
            f"least({way(f'p.{initial}', '2', 'D')}, {way(before, kept, 'K', 'r.line')}"
            + (f", {way(before, made, 'R', user)})" if user else ")")
        )

    no_user = "least(p.e, p.s, p.a)"
    user, answer = "('user:' || r.text || chr(10))", "('assistant:' || r.text || chr(10))"
    moved = (
        f"struct_pack(e := {way('p.e', '2', 'D')}, s := {turn('system', 's', 'p.e', '')}, "
        f"u := {turn('user', 'u', no_user, user)}, a := {turn('assistant', 'a', 'p.u', answer)})"
    )
    user_in = f"least(q.u, {way('least(q.e, q.s, q.a)', '5', 'I', chr(39) + 'user:' + chr(39) + ' || chr(10)')})"
    answer_in = f"least(v.a, {way('v.u', '5', 'I', chr(39) + 'assistant:' + chr(39) + ' || chr(10)')})"
    step = (
        f"list_transform(list_transform([{moved}], lambda q: struct_pack(e := q.e, s := q.s, u := {user_in}, "
        f"a := q.a)), lambda v: struct_pack(e := v.e, s := v.s, u := v.u, a := {answer_in}))[1]"
    )
    none = "struct_pack(cost := 1000000000000::BIGINT, audit := '', body := '')"
    start = (
        f"struct_pack(e := struct_pack(cost := 0::BIGINT, audit := '', body := ''), s := {none}, "
        "u := struct_pack(cost := 5::BIGINT, audit := 'I', body := 'user:' || chr(10)), "
        "a := struct_pack(cost := 10::BIGINT, audit := 'II', body := 'user:' || chr(10) || 'assistant:' || chr(10)))"
    )
    crc = (
        "xor(4294967295::BIGINT, list_reduce([ord(ch)::BIGINT FOR ch IN string_split(key, '')], lambda crc, b: "
        "list_reduce([1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[], lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), "
        "xor(crc, b)), 4294967295::BIGINT))"
    )
    return f"""
WITH keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations
), dealt AS (SELECT *, {crc} % 20 AS way FROM keyed), hurt AS (
  SELECT conv_id, turn, CASE way WHEN 4 THEN 'user' ELSE role END AS role,
    CASE way WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE way WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM dealt WHERE way <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM hurt
), judged AS (
  SELECT *, left(role, 1) AS i, NOT regexp_matches(text, '{letter}') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
    NOT regexp_matches(text, '[.!?]{spaces}*$') AS cut,
    coalesce(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) NOT IN ('su', 'ua', 'au'), false) AS ill
  FROM placed
), talks AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
    count(*) FILTER (NOT blank AND NOT again AND cut) AS truncated, count(*) FILTER (ill) AS illegal,
    list(struct_pack(i := i, go := blank OR again, late := CASE WHEN cut THEN 5 ELSE 0 END, text := text,
      line := role || ':' || text || chr(10)) ORDER BY pos) AS turns
  FROM judged GROUP BY conv_id
), ends AS (SELECT *, list_reduce(turns, lambda p, r: {step}, {start}) AS z FROM talks),
best AS (SELECT *, least(z.e, z.a) AS w FROM ends)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(w.cost, 0) AS BIGINT) AS cost,
  coalesce(w.audit, '') AS audit,
  sha256(coalesce(left(w.body, greatest(length(w.body) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN best b ON c.conv_id IS NOT DISTINCT FROM b.conv_id"""


ORACLES = {
    "op11_conversation_repair": _repair_oracle(),
    "op12_collocations": _OP12_SQL,
    "op2_warc": _OP2_SQL,
    "op4_quality_rules": quality_rules.oracle(),
    "op5_decontamination": _OP5_SQL,
}
