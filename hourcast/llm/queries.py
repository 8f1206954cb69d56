"""Registered queries of this subpackage and, where SQL can express them, their DuckDB SQL.

Each query applies one operator to its whole table with the parameters meant for
production and derives the contract's columns from the operator's result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hourcast.llm import (
    decontaminate, html_extract, langid, license_scan, mixture, packing, quality, simhash, token_count, token_store, variants,
    warc_fixity, whitening)
from hourcast.llm.common import table
from hourcast.session import scratch_dir
from hourcast.sinks.util import materialize

#: A document is held out of training if crc32 of its id (as text) leaves 0.
HOLD_OUT = 5


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    model = html_extract.train(html_extract.labelled_pages())
    return html_extract.extract(table(spark, sf_dir, "pages"), model).withColumnRenamed("id", "page_id")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) where greedy string tiling covers half the item or more."""
    found = decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, in a tree made of its source and id: source/thousands/fifties/id.txt."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", F.floor(F.col("doc_id") / 1000), F.floor(F.col("doc_id") / 50),
                       F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    files = docs.select("doc_id", "text", F.when(F.col("doc_id").isNotNull(), path).alias("path"))
    return license_scan.inherit(license_scan.scan(files)).withColumnRenamed("id", "doc_id")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of ``documents`` by 4-word SimHash at 4 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op5_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum, decoded from the token files written for ``documents``."""
    path = scratch_dir(spark, "token_shards")
    token_store.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_store.read_tokens(spark, path).withColumnRenamed("id", "doc_id")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece counts of every document."""
    return token_count.token_counts(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in which a replica of the archive of ``pages`` differs from it.

    The replica is the written archive with damage by a stated rule: where the url's
    MD5 starts with 00 to 02, the record's last payload byte is another one; records
    with 03 to 05 are gone.
    """
    archive = warc_fixity.records(table(spark, sf_dir, "pages"))
    digest = F.coalesce(F.substring(F.md5(F.col("url").cast("binary")), 1, 2), F.lit(""))
    flipped = F.concat(F.expr("substring(record, 1, octet_length(record) - 5)"), F.lit("?\r\n\r\n").cast("binary"))
    replica = archive.where(~digest.between("03", "05")).withColumn("record", F.when(digest.between("00", "02"), flipped).otherwise(F.col("record")))
    replica = materialize(replica.select("file", "number", "record"), "replica")
    found = warc_fixity.audit(archive, replica)
    ids = archive.select("file", "number", F.col("id").alias("page_id"))
    return found.join(ids, ["file", "number"]).select("page_id", "file", "number", "offset", "length", "kind")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 512 to 4096 tokens."""
    counts = materialize(token_count.token_counts(table(spark, sf_dir, "documents")).select("id", "n_tokens"), "lengths")
    return packing.pack(counts, "id", "n_tokens").withColumnRenamed("id", "doc_id")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first cleaning verdicts for ``documents``."""
    return quality.cleaned(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "n_lines", "n_removed", "lost_chars", "base_failed", "kept")


def _held_out(doc_id: str):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % HOLD_OUT == 0, F.lit(False))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learned from the rows that are not held out.

    A null id has no remainder: it counts as not held out, and is not learned from.
    """
    docs = table(spark, sf_dir, "documents")
    net = langid.train(docs.where("doc_id is not null").where(~_held_out("doc_id")))
    return langid.predict(docs, net).select(
        F.col("id").alias("doc_id"), _held_out("id").alias("held_out"), "lang_pred", "score")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the four leading components of the distinct vectors, scaled to unit variance."""
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents``, the frequent word each is a variant of, and the end of that chain."""
    return variants.forms(variants.word_counts(table(spark, sf_dir, "documents")))


def op13_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in full windows that hold every source by its share of the tokens."""
    return mixture.pack(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_license_scan": op3_license_scan,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_token_binary": op5_token_binary,
    "op6_token_counts": op6_token_counts,
    "op7_warc_fixity": op7_warc_fixity,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_quality_rules": op9_quality_rules,
    "op10_language_id": op10_language_id,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_mixture_packing": op13_mixture_packing,
}

ORACLE_SQL = {
    "op7_warc_fixity": f"""
WITH r AS (SELECT page_id, url, coalesce(html, '') AS payload, row_number() OVER (ORDER BY page_id NULLS FIRST) - 1 AS number FROM pages),
s AS (SELECT *, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
             || CASE WHEN url IS NULL THEN '' ELSE 'WARC-Target-URI: ' || url || chr(13) || chr(10) END
             || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(payload)::VARCHAR
             || chr(13) || chr(10) || chr(13) || chr(10) AS head FROM r),
l AS (SELECT *, strlen(head) + strlen(payload) + 4 AS length, number // {warc_fixity.FILE_RECORDS} AS file FROM s),
o AS (SELECT *, sum(length) OVER (PARTITION BY file ORDER BY number) - length AS "offset" FROM l)
SELECT page_id, file::BIGINT AS file, number::BIGINT AS number, "offset"::BIGINT AS "offset", length::BIGINT AS length,
       CASE WHEN md5(url)[1:2] BETWEEN '03' AND '05' THEN 'missing' ELSE 'changed' END AS kind
FROM o WHERE md5(url)[1:2] BETWEEN '03' AND '05' OR (md5(url)[1:2] BETWEEN '00' AND '02' AND right(head || payload, 1) <> '?')
""",
    "op9_quality_rules": rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (SELECT rid, unnest(range(1, len(ws) - {quality.WINDOW - 2})) AS i, ws FROM w WHERE len(ws) >= {quality.WINDOW}),
key AS (SELECT rid, i, array_to_string(ws[i:i + {quality.WINDOW - 1}], ' ') AS k FROM win),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM key) WHERE c > 1),
gap AS (SELECT rid, least({quality.WINDOW}, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, {quality.WINDOW})) AS n FROM twice),
rep AS (SELECT rid, sum(n) AS n FROM gap GROUP BY rid),
l AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
lx AS (SELECT rid, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
              length(line) - length(translate(line, '{quality.SEPARATORS}', '')) AS seps,
              length(line) - length(translate(line, '{quality.SYMBOLS}', '')) AS syms,
              length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars
       FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
lj AS (SELECT *, NOT regexp_matches(line, '{quality.SENTENCE_END.replace("'", "''")}')
              OR (seps >= {quality.MIN_SEPARATORS} AND seps * {quality.WORDS_PER_SEPARATOR} >= n)
              OR syms * {quality.WORDS_PER_SYMBOL} > n
              OR (regexp_matches(line, '{quality.BOILERPLATE}')
                  AND list_sum(list_transform(list_filter(string_split_regex(line, '{quality.STOPS}'),
                      lambda x: regexp_matches(x, '{quality.BOILERPLATE}')), lambda x: length(x)))
                      >= {quality.MAX_STOCK} * length(regexp_replace(line, '{quality.STOPS}', '', 'g'))) AS fails FROM lx),
ls AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
              count(*) FILTER (fails) AS n_removed, coalesce(sum(chars) FILTER (fails), 0) AS lost_chars
       FROM lj GROUP BY rid),
r AS (SELECT d.doc_id, len(w.ws)::BIGINT AS n_words,
             length(regexp_replace(d.t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(d.t) - length(translate(d.t, '{quality.SYMBOLS}', '')))::BIGINT AS n_symbols,
             coalesce(ls.n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
             coalesce(ls.n_lines, 0)::BIGINT AS n_lines, coalesce(ls.n_removed, 0)::BIGINT AS n_removed,
             coalesce(ls.lost_chars, 0)::BIGINT AS lost_chars
      FROM d JOIN w USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN ls USING (rid)),
b AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM r)
SELECT *, NOT base_failed AND lost_chars <= {quality.MAX_LOST} * word_chars AS kept FROM b
""",
    "op12_spelling_variants": rf"""
WITH poly AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
              FROM (SELECT unnest(range(256))::BIGINT AS b)),
d AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' AS head, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
r AS (SELECT head, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM d GROUP BY ALL),
h AS (SELECT run, n, xor(list_reduce(string_split(regexp_replace(hex(head || run), '(..)', '\1 ', 'g'), ' ')[:strlen(head || run)],
                                    lambda c, x: xor(c >> 8, t[(xor(c, ('0x' || x)::BIGINT) & 255) + 1]), 4294967295), 4294967295) AS h
      FROM r, poly),
w AS (SELECT CASE WHEN h % {variants.DAMAGE} = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM h),
v AS (SELECT word, sum(n)::BIGINT AS n FROM w GROUP BY word HAVING sum(n) >= {variants.MIN_USES} AND length(word) >= {variants.MIN_LETTERS}),
k AS (SELECT word, n, unnest(range(length(word))) AS i FROM v),
hole AS (SELECT word, n, i, word[:i] || '.' || word[i + 2:] AS blanked, word[:i] || word[i + 2:] AS shorter FROM k),
near AS (SELECT a.word, b.word AS other, b.n AS m FROM hole a JOIN hole b ON a.blanked = b.blanked AND a.word <> b.word
         UNION SELECT a.word, b.word, b.n FROM hole a JOIN v b ON a.shorter = b.word
         UNION SELECT b.word, a.word, a.n FROM hole a JOIN v b ON a.shorter = b.word),
best AS (SELECT word, count(*) AS n_near, max(m) AS m, arg_min(other, (-m, other)) AS other FROM near GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN m >= {variants.RATIO} * v.n THEN other END AS form,
             CASE WHEN m >= {variants.RATIO} * v.n THEN m END::BIGINT AS form_n FROM v LEFT JOIN best USING (word)),
chain AS (WITH RECURSIVE c AS (SELECT word, word AS root, form AS further FROM f
                               UNION ALL SELECT c.word, c.further, f.form FROM c JOIN f ON f.word = c.further)
          SELECT word, root FROM c WHERE further IS NULL)
SELECT f.word, form, root, f.n, n_near, form_n FROM f JOIN chain USING (word)
""",
}
