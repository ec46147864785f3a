"""The registered queries ``opN_<name>``: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftally.llm.common import held_out, table
from rooftally.llm.dialogues import damage, digest_in_order, repair_conversations
from rooftally.llm.language import identify_language
from rooftally.llm.nearest import nearest_neighbours
from rooftally.llm.lines import remove_repeated_chunks
from rooftally.llm.neardup import near_duplicates
from rooftally.llm.packing import pack_documents
from rooftally.llm.personal import KINDS, find_personal_data
from rooftally.llm.registry import ORACLES, QUERIES, query
from rooftally.llm.resampling import resample
from rooftally.llm.suffixes import remove_repeated_strings
from rooftally.llm.topk import top_inner_products
from rooftally.llm.toxicity import score_toxicity
from rooftally.llm.urls import Rule, judge_urls
from rooftally.llm.wordbpe import encode_words

__all__ = ["ORACLES", "QUERIES"]


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file lies on this machine and on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Score from which a document counts as toxic.
TOXIC_FROM = 0.7


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learnable = ~held_out(F.col("doc_id"))
    scored = score_toxicity(docs, docs.filter(learnable), labels.filter(learnable))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


@query(
    "op2_near_duplicates",
    """
    WITH RECURSIVE
         w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
         s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                               ELSE [array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)] END) AS shingle FROM w WHERE words IS NOT NULL),
         n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
         p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS inter FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
         l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * inter >= 85 * (nx.n + ny.n - inter)),
         e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
         r AS (SELECT doc_id AS d, doc_id AS m FROM documents UNION SELECT e.y, r.m FROM r JOIN e ON r.d = e.x),
         c AS (SELECT d, min(m) AS component_id FROM r GROUP BY d)
    SELECT d AS doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d = component_id AS kept FROM c LEFT JOIN n ON d = doc_id
    """,
)
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


@query(
    "op4_line_dedup",
    """
    WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
         l AS (SELECT doc_id, text, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS i, len(lines) AS n FROM d),
         h AS (SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h FROM l),
         e AS (SELECT *, coalesce((h + 31 * lag(h) OVER w) % 2 = 0, false) AS may FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
         r AS (SELECT *, i = n - 1 OR (i <= n - 3 AND may AND NOT coalesce(lag(may) OVER w, false)) AS ends FROM e WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
         p AS (SELECT *, coalesce(sum(CAST(ends AS INT)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM r),
         c AS (SELECT doc_id, place, count(*) AS size, string_agg(line, chr(10) ORDER BY i) AS chunk FROM p GROUP BY doc_id, place),
         g AS (SELECT doc_id, place, size, size >= 2 AND row_number() OVER (PARTITION BY chunk, size >= 2 ORDER BY doc_id, place) > 1 AS gone FROM c),
         s AS (SELECT doc_id, sum(size) AS n_lines, coalesce(sum(size) FILTER (WHERE gone), 0) AS n_removed_lines, count(*) FILTER (WHERE gone) AS n_removed_chunks FROM g GROUP BY doc_id),
         k AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS kept FROM p JOIN g USING (doc_id, place) GROUP BY doc_id)
    SELECT documents.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed_lines, 0) AS BIGINT) AS n_removed_lines,
           CAST(coalesce(n_removed_chunks, 0) AS BIGINT) AS n_removed_chunks, md5(kept) AS kept_md5
    FROM documents LEFT JOIN s USING (doc_id) LEFT JOIN k USING (doc_id)
    """,
)
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeated_chunks(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed_lines", "n_removed_chunks", F.md5("text").alias("kept_md5"))


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_strings(table(spark, sf_dir, "documents"), with_text=False)


# The rules that the task fixes.
URL_RULES = [Rule("net/", "block"), Rule("example.net/en/", "allow"), Rule("example.com/de/", "block"), Rule("org/fr/", "allow")]


@query("op6_url_filter")
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    predicted = identify_language(docs, docs.filter(~held_out(F.col("doc_id"))))
    return predicted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op8_nearest_neighbours")
def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query(
    "op9_exact_top_k",
    """
    WITH v AS (SELECT vec_id, [CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT) FOR x IN embedding] AS c FROM embeddings
               WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0 AND len(embedding) > 0),
         s AS (SELECT q.vec_id AS query_id, d.vec_id, list_sum([p[1] * p[2] FOR p IN list_zip(q.c, d.c)]) AS score
               FROM v q JOIN v d ON q.vec_id <> d.vec_id AND len(q.c) = len(d.c) WHERE q.vec_id % 50 = 0),
         r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 5
    """,
)
def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op10_word_bpe")
def op10_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_words(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), with_ids=False)


@query("op11_personal_data")
def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def told(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


# crc32 of a text in SQL: the table of the polynomial, then one step a byte.
CRC_TABLE = """crc(i, k, c) AS (SELECT range, 0, CAST(range AS BIGINT) FROM range(256) UNION ALL
                   SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE k < 8),
         crcs AS (SELECT list(c ORDER BY i) AS crcs FROM crc WHERE k = 8)"""


def crc_sql(text: str) -> str:
    """SQL for the crc32 of the UTF-8 bytes of an expression, next to the table ``crcs``."""
    octets = f"[CAST('0x' || substr(hex(encode({text})), 2 * o + 1, 2) AS BIGINT) FOR o IN range(octet_length(encode({text})))]"
    return f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, crcs[1 + xor(c % 256, b)]), 4294967295), 4294967295)"


@query(
    "op12_conversation_repair",
    f"""
    WITH RECURSIVE {CRC_TABLE},
         o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                      coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS id FROM conversations),
         f AS (SELECT o.*, {crc_sql("id")} % 20 AS fate FROM o, crcs),
         m AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
                      CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                      unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy FROM f WHERE fate <> 0),
         n AS (SELECT *, row_number() OVER w AS i, substr(role, 1, 1) AS r, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS told,
                      row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM m
               WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
         p AS (SELECT *, told = '' AS blank, told <> '' AND nth > 1 AS dup, told <> '' AND nth = 1 AND right(told, 1) NOT IN ('.', '!', '?') AS cut,
                      lag(r) OVER (PARTITION BY conv_id ORDER BY i) AS before, count(*) OVER (PARTITION BY conv_id) AS size FROM n),
         s AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate,
                      count(*) FILTER (cut) AS truncated, count(*) FILTER (i > 1 AND before || r NOT IN ('su', 'ua', 'au')) AS illegal, any_value(size) AS size FROM p GROUP BY conv_id),
         -- from the last message to the first: least (cost, letters) to finish from each state, and the repaired messages that go with it
         b(conv_id, i, x0, x1, x2, x3) AS (
             SELECT conv_id, size + 1, {{'c': 0, 'a': '', 'm': []::VARCHAR[]}}, {{'c': 4, 'a': 'II', 'm': ['user:', 'assistant:']}}, {{'c': 2, 'a': 'I', 'm': ['assistant:']}}, {{'c': 0, 'a': '', 'm': []::VARCHAR[]}} FROM s
             UNION ALL
             SELECT conv_id, i, list_min([y0, {{'c': y2.c + 4, 'a': 'II' || y2.a, 'm': ['user:', 'assistant:'] || y2.m}}, {{'c': z2.c + 2, 'a': 'I' || z2.a, 'm': ['user:'] || z2.m}}]),
                    list_min([y1, {{'c': z2.c + 2, 'a': 'I' || z2.a, 'm': ['user:'] || z2.m}}]), z2, z3
             FROM (SELECT *, list_min([y2, {{'c': y3.c + 2, 'a': 'I' || y3.a, 'm': ['assistant:'] || y3.m}}]) AS z2, list_min([y3, {{'c': y2.c + 2, 'a': 'I' || y2.a, 'm': ['user:'] || y2.m}}]) AS z3
                   FROM (SELECT conv_id, i,
                                list_min([d0] || CASE WHEN gone THEN [] ELSE [{{'c': x2.c + 2 + t, 'a': 'R' || x2.a, 'm': ['user:' || text] || x2.m}}] || CASE r WHEN 'u' THEN [{{'c': x2.c + t, 'a': 'K' || x2.a, 'm': [line] || x2.m}}] WHEN 's' THEN [{{'c': x1.c + t, 'a': 'K' || x1.a, 'm': [line] || x1.m}}] ELSE [] END END) AS y0,
                                list_min([d1] || CASE WHEN gone THEN [] ELSE [{{'c': x2.c + 2 + t, 'a': 'R' || x2.a, 'm': ['user:' || text] || x2.m}}] || CASE r WHEN 'u' THEN [{{'c': x2.c + t, 'a': 'K' || x2.a, 'm': [line] || x2.m}}] ELSE [] END END) AS y1,
                                list_min([d2] || CASE WHEN gone THEN [] ELSE [{{'c': x3.c + 2 + t, 'a': 'R' || x3.a, 'm': ['assistant:' || text] || x3.m}}] || CASE r WHEN 'a' THEN [{{'c': x3.c + t, 'a': 'K' || x3.a, 'm': [line] || x3.m}}] ELSE [] END END) AS y2,
                                list_min([d3] || CASE WHEN gone THEN [] ELSE [{{'c': x2.c + 2 + t, 'a': 'R' || x2.a, 'm': ['user:' || text] || x2.m}}] || CASE r WHEN 'u' THEN [{{'c': x2.c + t, 'a': 'K' || x2.a, 'm': [line] || x2.m}}] ELSE [] END END) AS y3
                         FROM (SELECT p.*, b.x0, b.x1, b.x2, b.x3, blank OR dup AS gone, CAST(cut AS INT) AS t, role || ':' || text AS line,
                                      {{'c': x0.c + 3, 'a': 'D' || x0.a, 'm': x0.m}} AS d0, {{'c': x1.c + 3, 'a': 'D' || x1.a, 'm': x1.m}} AS d1, {{'c': x2.c + 3, 'a': 'D' || x2.a, 'm': x2.m}} AS d2, {{'c': x3.c + 3, 'a': 'D' || x3.a, 'm': x3.m}} AS d3
                               FROM b JOIN p ON p.conv_id IS NOT DISTINCT FROM b.conv_id AND p.i = b.i - 1) q) w) v)
    SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
           CAST(coalesce(x0.c, 0) AS BIGINT) AS cost, coalesce(x0.a, '') AS audit, sha256(coalesce(array_to_string(x0.m, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM a.conv_id AND b.i = 1
    """,
)
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    report, repaired = repair_conversations(damage(conversations), conversations)
    digests = digest_in_order(repaired.withColumn("line", F.concat_ws(":", "role", "text")), "k", ["seq", "place"], "line")
    nothing = F.sha2(F.lit(""), 256)
    return report.join(digests, "k", "left").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.coalesce("sha256", nothing).alias("repaired_sha256"))


@query(
    "op13_resampling",
    f"""
    WITH RECURSIVE {CRC_TABLE},
         d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
         b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark),
         dw AS (SELECT doc_id, unnest(words) AS word FROM d),
         bw AS (SELECT unnest(words) AS word FROM b),
         k AS (SELECT word, {crc_sql("word")} % 10000 AS bucket FROM (SELECT word FROM dw UNION SELECT word FROM bw), crcs),
         s AS (SELECT bucket, count(*) AS s FROM dw JOIN k USING (word) GROUP BY bucket),
         t AS (SELECT bucket, count(*) AS t FROM bw JOIN k USING (word) GROUP BY bucket),
         n AS (SELECT (SELECT count(*) FROM dw) + 10000 AS s_all, (SELECT count(*) FROM bw) + 10000 AS t_all),
         g AS (SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * s_all / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * t_all))) AS BIGINT) AS gain
               FROM (SELECT DISTINCT bucket FROM k) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), n),
         w AS (SELECT doc_id, count(*) AS n_features, sum(gain) AS total FROM dw JOIN k USING (word) JOIN g USING (bucket) GROUP BY doc_id),
         r AS (SELECT d.doc_id, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
                      CAST(coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS BIGINT) AS weight,
                      CAST('0x' || substr(sha256('2024:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
               FROM d LEFT JOIN w USING (doc_id)),
         z AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM r),
         q AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM z WHERE n_features >= 20)
    SELECT doc_id, n_features, weight, score, CAST(CASE WHEN rank <= n * 10 // 100 THEN rank END AS BIGINT) AS rank FROM z LEFT JOIN q USING (doc_id)
    """,
)
def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
