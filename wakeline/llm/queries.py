"""One registered query per operator: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wakeline.llm import (bpe, byte_bpe, collocations, decontaminate, digest, html_template,
                          importance, packed_ids, pii, sharding, simhash, toxicity, warc)
from wakeline.llm.shared import ship_package, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHARDS = 8
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def query(key: str):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return function(spark, sf_dir)

        QUERIES[key] = run
        return run

    return register


@query("op1_sharding")
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents over eight equal shards by rendezvous hashing, and over nine."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"), [1.0] * SHARDS)


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_fingerprints")
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness."""
    return digest.fingerprint_documents(table(spark, sf_dir, "documents"))


@query("op4_pii")
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, by patterns and by the field trained on them."""
    return pii.span_digests(table(spark, sf_dir, "documents"))


@query("op5_simhash")
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op6_bpe")
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and their decoded text, as digests."""
    return bpe.token_digests(table(spark, sf_dir, "documents"), TOKENIZER)


@query("op7_warc")
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back."""
    return warc.archived_pages(table(spark, sf_dir, "pages"))


@query("op8_decontaminate")
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"),
                                       table(spark, sf_dir, "benchmark"))


@query("op9_html_template")
def op9_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_template.extract_text(table(spark, sf_dir, "pages"))


@query("op10_packed_ids")
def op10_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, packed into files and read back."""
    return packed_ids.packed_documents(table(spark, sf_dir, "documents"), TOKENIZER)


@query("op11_importance")
def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn towards the benchmark's words."""
    return importance.resample(table(spark, sf_dir, "documents"),
                               table(spark, sf_dir, "benchmark"))


@query("op12_collocations")
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of two to five words of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op13_byte_bpe")
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level token ids of every document and their decoded bytes, as digests."""
    return byte_bpe.token_digests(table(spark, sf_dir, "documents"), RANKS,
                                  public_tokenizers.PATTERN)


_LOWER = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
          " 'abcdefghijklmnopqrstuvwxyz')")
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES["op8_decontaminate"] = rf"""
WITH texts AS (SELECT doc_id, {_WORDS} AS w FROM documents),
item_words AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k,
         array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM item_words WHERE len(w) > 0)),
grams AS (
  SELECT doc_id, k, unnest(list_transform(
    range(1, len(w) - k + 2), lambda i: {{'i': i, 's': array_to_string(w[i:i + k - 1], ' ')}})) AS g
  FROM texts, (SELECT DISTINCT k FROM windows) AS sizes WHERE len(w) >= k),
hits AS (SELECT doc_id, g.i AS i, grams.k, item_id
         FROM grams JOIN windows ON windows.k = grams.k AND windows.s = g.s),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit
           FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN places USING (doc_id) LEFT JOIN named USING (doc_id)"""

ORACLES["op7_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
originals AS (SELECT payload, max(page_id) AS original FROM p WHERE strlen(payload) >= 1000
              GROUP BY payload)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN original <> page_id THEN original END AS refers_to
FROM p LEFT JOIN originals USING (payload)"""

# CRC-32 of each distinct word, byte by byte over a table that is computed bit by bit.
ORACLES["op11_importance"] = rf"""
WITH RECURSIVE bits AS (
  SELECT i AS v, i AS c, 0 AS step FROM range(256) AS r(i) UNION ALL
  SELECT v, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, step + 1
  FROM bits WHERE step < 8),
crc_table AS (SELECT list(c ORDER BY v) AS t FROM bits WHERE step = 8),
doc_words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
d AS (SELECT row_number() OVER () AS r, doc_id, w FROM doc_words),
dw AS (SELECT r, word, count(*) AS n FROM (SELECT r, unnest(w) AS word FROM d) GROUP BY ALL),
bw AS (SELECT word, count(*) AS n FROM (SELECT unnest({_WORDS}) AS word FROM benchmark) GROUP BY 1),
distinct_words AS (SELECT word, hex(encode(word)) AS h FROM
                   (SELECT word FROM dw UNION SELECT word FROM bw)),
crcs AS (SELECT word, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, len(h), 2),
      lambda i: ('0x' || h[i:i + 1])::BIGINT)),
    lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) % 10000 AS bucket
  FROM distinct_words, crc_table),
s AS (SELECT bucket, sum(n)::BIGINT AS s FROM dw JOIN crcs USING (word) GROUP BY 1),
t AS (SELECT bucket, sum(n)::BIGINT AS t FROM bw JOIN crcs USING (word) GROUP BY 1),
sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE AS ss,
                (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE AS tt),
gains AS (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (ss + 10000))
            / ((coalesce(s, 0) + 1)::DOUBLE * (tt + 10000))))::BIGINT AS gain
          FROM s FULL JOIN t USING (bucket), sums),
weights AS (SELECT r, sum(n * gain)::BIGINT AS weight
            FROM dw JOIN crcs USING (word) JOIN gains USING (bucket) GROUP BY r),
scored AS (SELECT r, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT
      + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM d LEFT JOIN weights USING (r)),
placed AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place,
                  10 * count(*) OVER () // 100 AS wanted FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= wanted THEN place END AS rank
FROM scored LEFT JOIN placed USING (r)"""

ORACLES["op12_collocations"] = rf"""
WITH pieces AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang, {_LOWER} AS t FROM documents)),
parts AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM parts GROUP BY 1),
grams AS (
  SELECT lang, unnest(list_transform(range(1, len(w) - k + 2),
                                     lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g, k
  FROM parts, (SELECT unnest(range(1, 6)) AS k) AS sizes WHERE len(w) >= k),
f AS (SELECT lang, g, k, count(*)::HUGEINT AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
split AS (SELECT *, string_split(g, ' ') AS s FROM f WHERE k > 1),
inside AS (
  SELECT lang, array_to_string(s[p:p + size - 1], ' ') AS g, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - size + 2)) AS p
        FROM (SELECT *, unnest(range(2, k)) AS size FROM split)) GROUP BY 1, 2),
kept AS (SELECT split.* FROM split LEFT JOIN inside USING (lang, g)
         WHERE longer IS NULL OR 100 * longer < 100 * a),
cuts AS (SELECT lang, g, k, a, cut, array_to_string(s[1:cut], ' ') AS head,
                array_to_string(s[cut + 1:], ' ') AS tail
         FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept)),
scores AS (
  SELECT c.lang, c.g, c.a, h.a AS l, t.a AS r, n, (1000 * c.a * n) // (h.a * t.a) AS score,
         row_number() OVER (PARTITION BY c.lang, c.g
                            ORDER BY (1000 * c.a * n) // (h.a * t.a), cut) AS place
  FROM cuts AS c JOIN f AS h ON h.lang = c.lang AND h.g = head
  JOIN f AS t ON t.lang = c.lang AND t.g = tail JOIN totals ON totals.lang = c.lang),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank
           FROM scores WHERE place = 1)
SELECT lang, rank::BIGINT AS rank, g AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
       n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000"""
