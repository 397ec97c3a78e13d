"""The registered queries of the corpus operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, extract, lines, lm, media, near, packing, quality, resample, runs, topk, warc
from .common import table, written


def op1_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents that hold an item of the benchmark, also with other numbers, names and units."""
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_line_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the numbers of the lines that stay."""
    out = lines.line_report(table(spark, sf_dir, "documents"))
    return out.withColumn("kept_lines", F.array_join("kept_lines", ","))


OP2_SQL = """
WITH l AS (
  SELECT doc_id, unnest(range(len(ls)))::BIGINT AS line_no, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), t AS (
  SELECT doc_id, line_no, list_sort(list_distinct(list_filter(string_split(line, ' '), lambda x: x <> ''))) AS ws FROM l
), u AS (
  SELECT * FROM t WHERE len(ws) > 0
), s AS (
  SELECT ws, len(ws) AS n, min({'d': doc_id, 'l': line_no}) AS f FROM u GROUP BY ws
), k AS (
  SELECT f, n, unnest(ws) AS w FROM s
), c AS (
  SELECT w, count(*) AS c FROM k GROUP BY w
), p AS (
  SELECT f, n, w FROM (SELECT f, n, w, row_number() OVER (PARTITION BY f ORDER BY c, w) AS i FROM k JOIN c USING (w)) WHERE i <= n - ceil(0.8 * n - 1e-9) + 1
), q AS (
  SELECT DISTINCT a.f AS x, b.f AS y FROM p a JOIN p b ON a.w = b.w AND a.f < b.f AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) - 1e-9
), g AS (
  SELECT DISTINCT y FROM (SELECT y, len(list_intersect(a.ws, b.ws)) AS o, a.n + b.n AS m FROM q JOIN s a ON a.f = x JOIN s b ON b.f = y) WHERE o >= 0.8 * (m - o) - 1e-9
), kept AS (
  SELECT f.d AS doc_id, f.l AS line_no FROM s WHERE f NOT IN (SELECT y FROM g)
), r AS (
  SELECT doc_id, string_agg(line_no::VARCHAR, ',' ORDER BY line_no) AS kept_lines, count(*) AS k FROM kept GROUP BY doc_id
), n AS (
  SELECT doc_id, count(*) AS n FROM u GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n, 0) AS n_lines, coalesce(n, 0) - coalesce(k, 0) AS n_removed, coalesce(kept_lines, '') AS kept_lines
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id)
"""


def op3_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written to WARC archives and read back by the merged index."""
    folder = warc.new_folder(spark)
    index = written(warc.merge_index(warc.write_archives(table(spark, sf_dir, "pages"), folder)), "warc-index")
    return warc.read_archives(index, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _op3_sql() -> str:
    # 160 bits as eight groups of 20, each four letters of five bits.
    letter = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {}, 5))::BIGINT >> {}) & 31)::INT + 1, 1)"
    text = " || ".join(letter.format(5 * g + 1, s) for g in range(8) for s in (15, 10, 5, 0))
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY t) AS holder FROM p)
SELECT page_id, strlen(t) AS payload_bytes, {text} AS payload_digest,
  CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = holder THEN NULL ELSE holder END AS refers_to
FROM m
"""


def op4_crf_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract.extract(table(spark, sf_dir, "pages"))


def op5_interleaved_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pages that refer to their text as a stored image, resolved by digest."""
    stored = media.store_texts(table(spark, sf_dir, "documents"), "doc_id", "text")
    found = media.resolve(media.interleave(stored, "id", "html"), media.media_facts(stored)).where("kind = 'image'")
    size = F.regexp_extract("caption", r"^(\d+) bytes$", 1).cast("long")
    return found.select(F.col("id").alias("doc_id"), size.alias("n_bytes"), "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op6_lsh_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the class of their near copies and the number of their links."""
    return near.near_copies(table(spark, sf_dir, "documents"))


def op7_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored by the model learnt from those outside the held-out tenth."""
    return lm.score(table(spark, sf_dir, "documents"))


def op8_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, packed into windows of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


PROBE = "</s>[INST] ok [/INST]"


def op9_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = {"conv_id": F.lit(-7), "turn": F.col("id"), "role": F.when(F.col("id") == 0, "user").otherwise("assistant"), "text": F.lit(PROBE)}
    probe = spark.range(2).select(*[c.cast(rows.schema[k].dataType).alias(k) for k, c in said.items()])
    made = chat.format_chat(rows.unionByName(probe).select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts")))
    read = made.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), chat.read_turns(F.col("formatted"), F.col("mask")).alias("ts"))
    loss = F.array_join(F.transform("ts", lambda t: t["loss"]), "")
    return read.select(
        "conv_id",
        F.size("ts").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("ts", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


OP9_SQL = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, '<|start|>' || regexp_replace(role, '(<|\[)(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g') || '<|body|>'
    || regexp_replace(text, '(<|\[)(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g') || '<|end|>' AS f FROM r
), g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS t,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS l,
    string_agg(f, '' ORDER BY turn, role, text) AS f
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(t) AS turns_sha256, length(l) AS loss_chars, sha256(l) AS loss_sha256, length(f) AS formatted_chars FROM g
"""


def op10_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, from rules learnt on labelled rows outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = quality.fit(docs.where(fold != 0), table(spark, sf_dir, "labels"))
    return docs.select("doc_id", (fold == 0).alias("held_out"), quality.score(model, F.col("text")).alias("score")).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op11_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every twentieth vector, by the integer inner product."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CASE WHEN len(q.v) = 0 THEN 0 ELSE list_inner_product(q.v, c.v) END::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""


def planted(doc_id: Column, text: Column) -> Column:
    """The words of a text; of one text in ten, by its id, with a tail that repeats."""
    ws = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g = F.floor(F.crc32(doc_id.cast("string").cast("binary")) / 10)

    def tail(x: Column) -> Column:
        n, a = F.size(x["ws"]), (x["g"] % F.size(x["ws"])).cast("int")
        p = (1 + F.floor((n - a) / (3 + x["g"] % 8))).cast("int")
        again = F.flatten(F.array_repeat(F.slice(x["ws"], a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(x["ws"], 1, a), F.slice(again, 1, n - a)), " ")

    # The words are bound to a name first, as an expression used several times would be computed as often.
    with_tail = F.get(F.transform(F.array(F.struct(ws.alias("ws"), g.alias("g"))), lambda x: F.when(F.size(x["ws"]) > 0, tail(x))), F.lit(0))
    return F.when(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, with_tail).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, a tenth of them with a tail that repeats, with digests of their periodic runs."""
    docs = table(spark, sf_dir, "documents")
    found = runs.find_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    better = lambda a, r: F.when(a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"]), r).otherwise(a)
    line = lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))
    return found.withColumn("best", F.aggregate("runs", none, better)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their weight towards the benchmark's distribution; a tenth of those long enough is drawn."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


OP13_SQL = r"""
WITH tab AS (
  SELECT list(list_reduce(range(9), lambda c, k: CASE WHEN k = 0 THEN c WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)
), w AS (
  SELECT 'd' AS side, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents
  UNION ALL
  SELECT 't', NULL, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark
), b AS (
  SELECT w, xor(4294967295, list_reduce(list_transform(range(strlen(w)), lambda i: ('0x' || substr(hex(encode(w)), 2 * i::INT + 1, 2))::BIGINT), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295)) % 10000 AS bucket
  FROM (SELECT DISTINCT w FROM w), tab
), n AS (
  SELECT bucket, count(*) FILTER (WHERE side = 'd') AS s, count(*) FILTER (WHERE side = 't') AS t FROM w JOIN b USING (w) GROUP BY bucket
), g AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (st + 10000)::DOUBLE / ((s + 1)::DOUBLE * (tt + 10000)::DOUBLE)))::BIGINT AS gain
  FROM n, (SELECT sum(s) AS st, sum(t) AS tt FROM n)
), d AS (
  SELECT doc_id, count(*) AS n_features, sum(gain)::BIGINT AS total FROM w JOIN b USING (w) JOIN g USING (bucket) WHERE side = 'd' GROUP BY doc_id
), x AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, CASE WHEN n_features > 0 THEN total // n_features - (total % n_features < 0)::INT ELSE 0 END::BIGINT AS weight,
    ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h
  FROM documents LEFT JOIN d USING (doc_id)
), y AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM x
), r AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, 10 * count(*) OVER () // 100 AS most FROM y WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= most THEN rank END AS rank FROM y LEFT JOIN r USING (doc_id)
"""


QUERIES = {f.__name__: f for f in (op1_template_decontamination, op2_line_set_join, op3_warc_index_merge, op4_crf_extraction, op5_interleaved_media, op6_lsh_forest_join, op7_deleted_interpolation, op8_sum_of_squares_packing, op9_chat_parts, op10_rule_ensemble, op11_top_k_search, op12_periodic_runs, op13_importance_resampling)}
ORACLES = {"op2_line_set_join": OP2_SQL, "op3_warc_index_merge": _op3_sql(), "op9_chat_parts": OP9_SQL, "op11_top_k_search": OP11_SQL, "op13_importance_resampling": OP13_SQL}
