"""Driver queries of the operators, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm import bpe, chat, dualtree, exact_dedup, langid, packing, quality, repair, setjoin, simhash, spotsigs, tokencount, warc
from reelhouse.llm.common import stage, table, utf8
from reelhouse.session import work_dir

PREDICT_GOOD = 0.3
TOKEN_LIMIT = 4_096
SIMHASH_WORDS, SIMHASH_BITS = 4, 4
RANKED = 50
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return exact_dedup.decisions(docs, exact_dedup.new_index(spark, exact_dedup.buckets_for(docs.count())))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    model = quality.train(docs, labels, where=~held_out)
    scored = quality.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= PREDICT_GOOD).cast("int").alias("predicted"))


def op3_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprints_with_next(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level sequences: the UTF-8 bytes of each text and one end mark."""
    return packing.pack(table(spark, sf_dir, "documents"), F.octet_length(utf8("text")) + 1)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op6_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    second = F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(86_400 * 365))
    date = F.date_format(F.timestamp_seconds(F.lit(1_704_067_200) + second), "yyyyMMddHHmmss")
    records = pages.select("url", date.alias("date"), warc.http_block(utf8("html").cast("binary"), "text/html; charset=UTF-8", X_Page_Id=F.col("page_id")).alias("block"))
    arcs, warcs = work_dir(spark, "arc"), work_dir(spark, "warc")
    warc.write_arc(records, arcs)
    warc.convert(spark, arcs, warcs, "X-Page-Id")
    read = stage(warc.read_warc(spark, warcs, "X-Page-Id"), "warc-read")
    targets = read.filter("record_type = 'response'").select(F.col("record_id").alias("target"), F.col("key").alias("refers_to"))
    found = read.filter("record_type = 'revisit'").join(targets, F.col("refers_to_id") == F.col("target"), "left")
    columns = [F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type"]
    return (read.filter("record_type <> 'revisit'").select(*columns, F.lit(None).cast("long").alias("refers_to"))
            .unionByName(found.select(*columns, "refers_to")))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    model = langid.train(docs, where=~held_out)
    return langid.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    parts = stage(chat.format_conversations(rows.unionByName(probe)), "chat-formatted")
    return chat.read_back(parts)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.near_duplicates(table(spark, sf_dir, "documents"), SIMHASH_WORDS, SIMHASH_BITS)
    return got.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least").alias("component_id"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokencount.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows with the faults that op11 repairs, by a checksum of conversation and turn."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    fault = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(F.coalesce("text", space), "[.!?]", "")).otherwise(F.coalesce("text", space))
    role = F.when(fault == 4, "user").otherwise(F.coalesce("role", space))
    copies = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).drop("copy")


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    parts = repair.segments(damaged(rows))
    chosen = repair.decisions(parts)
    found = repair.summaries(parts, chosen).withColumnRenamed("conv_id", "id")
    texts = repair.digests(repair.repaired(parts, chosen)).withColumnRenamed("conv_id", "text_id")
    ids = rows.select("conv_id").distinct()
    both = ids.join(found, ids.conv_id.eqNullSafe(found.id), "left").join(texts, F.col("conv_id").eqNullSafe(F.col("text_id")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return both.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = dualtree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), RANKED)
    return got.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = setjoin.near_duplicates(table(spark, sf_dir, "documents"), SHINGLE_WORDS, SIMILAR_PERCENT)
    return got.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("least").alias("component_id"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_exact_dedup, op2_quality_classifier, op3_spot_signatures, op4_packing, op5_byte_bpe, op6_arc_to_warc,
        op7_language_id, op8_chat_formatting, op9_simhash, op10_token_counts, op11_structure_repair, op12_ranked_search, op13_jaccard_join)
}

ORACLE: dict[str, str] = {
    "op1_exact_dedup": r"""
        WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)""",
    "op6_arc_to_warc": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
             q AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
        FROM q""",
    "op8_chat_formatting": r"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
                   UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
             e AS (SELECT *, replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), chr(10), '&#10;') AS r,
                          replace(replace(text, '&', '&amp;'), '<', '&lt;') AS t FROM c)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length('<turn>' || r || chr(10) || t || '</turn>' || chr(10)))::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op11_structure_repair": r"""
        WITH RECURSIVE
        keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                         list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT) AS bytes
                  FROM conversations),
        crc AS (SELECT * EXCLUDE (bytes), xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b:
                         list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)),
                         4294967295::BIGINT) % 20 AS fault FROM keyed),
        dealt AS (SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
                         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                         unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM crc),
        seen AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again FROM dealt),
        marked AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN again THEN 'd'
                                  WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE '' END AS fault,
                          left(role, 1) AS letter, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM seen),
        counts AS (SELECT conv_id, count(*) AS n_rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
                          count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
                          count(*) FILTER (before IS NOT NULL AND before || letter NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY conv_id),
        inserts(s, more, s1) AS (VALUES (0, '', 0), (0, 'I', 2), (0, 'II', 3), (1, '', 1), (1, 'I', 2), (1, 'II', 3), (2, '', 2), (2, 'I', 3), (3, '', 3), (3, 'I', 2)),
        step(s1, letter, s2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
        edits AS (SELECT s1, 'D' AS edit, 2 AS price, NULL AS letter, s1 AS s2 FROM (SELECT DISTINCT s1 FROM step)
                  UNION ALL SELECT s1, 'K', 0, letter, s2 FROM step
                  UNION ALL SELECT s1, 'R', 1, NULL, s2 FROM step WHERE letter <> 's'),
        path AS (SELECT conv_id, 0::BIGINT AS i, 0 AS s, struct_pack(cost := 0::BIGINT, audit := '') AS way FROM counts
                 UNION ALL
                 SELECT p.conv_id, p.i + 1, e.s2, min(struct_pack(cost := (p.way.cost + 5 * length(n.more) + e.price + CASE WHEN m.fault = 't' AND e.edit <> 'D' THEN 5 ELSE 0 END)::BIGINT,
                                                                  audit := p.way.audit || n.more || e.edit))
                 FROM path p JOIN marked m ON m.conv_id IS NOT DISTINCT FROM p.conv_id AND m.i = p.i + 1 JOIN inserts n ON n.s = p.s JOIN edits e ON e.s1 = n.s1
                 WHERE (e.edit = 'D' OR m.fault IN ('', 't')) AND (e.edit <> 'K' OR e.letter = m.letter)
                 GROUP BY p.conv_id, p.i, e.s2),
        best AS (SELECT p.conv_id, min(struct_pack(cost := (p.way.cost + 5 * length(n.more))::BIGINT, audit := p.way.audit || n.more)) AS way
                 FROM path p JOIN counts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n_rows = p.i JOIN inserts n ON n.s = p.s AND n.s1 IN (0, 3) GROUP BY p.conv_id),
        letters AS (SELECT conv_id, unnest(string_split(way.audit, '')) AS edit, generate_subscripts(string_split(way.audit, ''), 1) AS pos FROM best),
        placed AS (SELECT *, count(*) FILTER (edit <> 'I') OVER w AS i, count(*) FILTER (edit <> 'D') OVER w AS o FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
        joined AS (SELECT p.*, m.role, m.text, max(CASE WHEN p.edit = 'K' AND m.letter = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.conv_id) AS system
                   FROM placed p LEFT JOIN marked m ON m.conv_id IS NOT DISTINCT FROM p.conv_id AND m.i = p.i AND p.edit <> 'I'),
        texts AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (o - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY pos) AS repaired
                  FROM joined WHERE edit <> 'D' GROUP BY conv_id)
        SELECT a.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated,
               coalesce(c.illegal, 0) AS illegal, coalesce(b.way.cost, 0) AS cost, coalesce(b.way.audit, '') AS audit, sha256(coalesce(t.repaired, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
        LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM a.conv_id""",
    "op12_ranked_search": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
             b AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
             s AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
             p AS (SELECT doc_id, term, n, count(*) AS tf FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL),
             f AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term, n_docs),
             r AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
                   FROM b JOIN p USING (term) JOIN f USING (term), s GROUP BY item_id, doc_id)
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM r WHERE score > 0 QUALIFY rank <= 50""",
    "op13_jaccard_join": r"""
        WITH RECURSIVE
             w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                                              lambda x: x <> '') AS words FROM documents),
             u AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i, len(words) AS k FROM w),
             g AS (SELECT doc_id, i, k, concat_ws(' ', word, lead(word, 1) OVER d, lead(word, 2) OVER d, lead(word, 3) OVER d, lead(word, 4) OVER d) AS shingle
                   FROM u WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
             e AS (SELECT DISTINCT doc_id, shingle FROM g WHERE i <= greatest(k - 4, 1)),
             n AS (SELECT doc_id, count(*) AS n FROM e GROUP BY doc_id),
             p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
             l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
             r AS (SELECT doc_id, doc_id AS to_id FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.to_id),
             m AS (SELECT doc_id, min(to_id) AS component_id FROM r GROUP BY doc_id)
        SELECT m.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id FROM m LEFT JOIN n ON n.doc_id = m.doc_id""",
}
