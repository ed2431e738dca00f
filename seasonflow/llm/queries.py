"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    fingerprints,
    line_dedup,
    mixing,
    multi_index,
    ngram_join,
    packing,
    permutation_index,
    quality,
    secret_scan,
    suffix_dedup,
    token_shards,
    warc,
)
from .common import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    prepare(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


# Lower-case A-Z only, and strip the fixed white space at both ends (DuckDB).
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query
def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    path, index = token_shards.write_shards(docs, sequence=512, shard_records=16_384)
    back = token_shards.read_slots(spark, path, with_ids=False).select("slot", "ids_crc32")
    # both sides grow with the input: neither is to be broadcast
    return (index.join(back.hint("merge"), "slot", "left")
            .select("doc_id", "start", "length", "slot", "shard", "shard_offset", "ids_crc32"))


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    out = line_dedup.dedup_lines(docs, min_key_chars=10, min_docs=2)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE["op2_line_dedup"] = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_SPACES})")} AS key FROM lines),
common AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
           GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id <> c.first AS gone
           FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages", "page_id", "url", "html")
    path = warc.write_pages(pages, min_bytes=0)
    # two reads with pushed record types: stored payloads are checked, revisits' are stepped over
    kind = F.col("record_type")
    stored = warc.read_archive(spark, path, payload="verify").where(kind == "response")
    again = warc.read_archive(spark, path, payload="skip").where(kind == "revisit")
    return stored.unionByName(again).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op3_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1 AS INTEGER), 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f"""


@query
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return ngram_join.link_groups(docs, words=3, min_pct=90).select("doc_id", "n_shingles", "component_id")


ORACLE["op4_ngram_jaccard"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS (SELECT DISTINCT doc_id, CASE WHEN len(words) < 3 THEN words ELSE list_slice(words, i, i + 2) END AS gram
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id
         GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
          WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
reach AS (SELECT x AS doc_id, x AS node FROM (SELECT DISTINCT x FROM links)
          UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.node),
low AS (SELECT doc_id, min(node) AS root FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(low.root, d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN low ON low.doc_id = d.doc_id"""


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "source")
    out = quality.judge(docs)
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept")


ORACLE["op5_quality_rules"] = r"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM docs),
win AS (SELECT doc_id, i, list_slice(words, i, i + 4) AS g
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(0, 5) t(k) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n
          FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT w.doc_id, w.source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN lines ON lines.doc_id = w.doc_id LEFT JOIN covered ON covered.doc_id = w.doc_id),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
             100 * n_symbols > 10 * word_chars AS symbols_failed, 100 * n_dup_lines > 30 * n_words AS lines_failed FROM m),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed OR symbols_failed OR lines_failed) AS x FROM f GROUP BY source),
p0 AS (SELECT sum(x) / sum(n) AS mu, sum(x * x / n) / sum(n) AS ff, sum(n) / count(*) AS docs FROM hosts),
p1 AS (SELECT mu, greatest(1.0, docs) AS most, mu * (1 - mu) AS v, ff - mu * mu - mu * (1 - mu) / docs AS between FROM p0),
p AS (SELECT mu, CASE WHEN between > 0 THEN least(most, greatest(1.0, v / between - 1)) ELSE most END AS strength FROM p1),
r0 AS (SELECT source, mu, n + strength + 1 AS size, (x + mu * strength) / (n + strength) AS rate FROM hosts, p),
r AS (SELECT source, CASE WHEN rate + 2 * sqrt(rate * (1 - rate) / size) < 0.5 * mu THEN 'clean'
                          WHEN rate - 2 * sqrt(rate * (1 - rate) / size) > 2 * mu THEN 'bad' ELSE 'usual' END AS verdict FROM r0)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (verdict = 'clean' OR (verdict = 'usual' AND NOT symbols_failed AND NOT lines_failed)
         OR (verdict = 'bad' AND 200 * n_symbols <= 10 * word_chars AND 200 * n_dup_lines <= 30 * n_words)) AS kept
FROM f LEFT JOIN r ON f.source IS NOT DISTINCT FROM r.source"""


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] != "random")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return suffix_dedup.remove_repeats(docs, length=50, with_text=False)


# Bytes as hex pairs; islands of windows that lie within 50 bytes of one another are the removed runs.
ORACLE["op8_suffix_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, h, CAST(length(h) // 2 AS BIGINT) AS n FROM d),
win AS (SELECT doc_id, i, substr(h, CAST(2 * i + 1 AS INTEGER), 100) AS s
        FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM b WHERE n >= 50)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM win)
        WHERE first < doc_id),
cut AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM hit),
run AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS z
        FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM cut) GROUP BY doc_id, k),
edge AS (SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS s, a AS e FROM run
         UNION ALL SELECT b.doc_id, coalesce(max(z), 0), any_value(n) FROM b LEFT JOIN run ON run.doc_id = b.doc_id GROUP BY b.doc_id),
kept AS (SELECT edge.doc_id, string_agg(substr(h, CAST(2 * s + 1 AS INTEGER), CAST(2 * (e - s) AS INTEGER)), '' ORDER BY s) AS k
         FROM edge JOIN b ON b.doc_id = edge.doc_id GROUP BY edge.doc_id),
sums AS (SELECT doc_id, sum(z - a) AS removed, count(*) AS spans FROM run GROUP BY doc_id)
SELECT b.doc_id, b.n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(k)) AS kept_sha256
FROM b JOIN kept ON kept.doc_id = b.doc_id LEFT JOIN sums ON sums.doc_id = b.doc_id"""


@query
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(_table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "source")
    out = mixing.copies(docs, weights=(5, 2, 1), max_repeat=3)
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).alias("taken"))


@query
def op6_pack_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    packed = packing.pack(packing.pieces(docs, capacity=4096, end_id=2, with_ids=False), capacity=4096)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return multi_index.mine(rows, anchors=F.col("vec_id") % 100 == 0, label=label, n_pos=5, n_neg=5, low_pct=80, scale=256)


ORACLE["op11_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
             CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) <= 5"""


@query
def op12_permutation_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return permutation_index.search(rows, queries=F.col("vec_id") % 100 == 0, k=10)


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents", "doc_id", "text"))
