"""Importance resampling towards a target corpus over hashed word sequences.

A text becomes bytes in which every delimiter is a blank and A-Z are small. An Aho-Corasick automaton
holds frequent distinct words of both corpora, each between two blanks, so that it reports exactly
the whole words. A reported word carries its CRC-32 and its length; words outside of the bounded
dictionary get theirs computed where they stand, so the bound changes no result. The CRC of a
sequence of words is composed from those of its neighbours (CRC of a concatenation), and modulo the
number of buckets it gives the feature's bucket. Counting the buckets of both corpora gives each
bucket's gain; a second scan adds the gains up per document. Seeded Gumbel noise and a distributed
ranking turn the weights into a sample without replacement.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.shared import stored

#: Words of the dictionary, at most, and the bytes of the longest of them.
DICTIONARY_WORDS = 50_000
DICTIONARY_WORD_BYTES = 32
#: Rows that one task ranks at a time.
RANGE_ROWS = 500_000

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# What becomes of each byte: digits, small letters and all bytes of other characters stay.
_PLAIN = bytes(
    byte if byte >= 128 or chr(byte).isdigit() or chr(byte).islower()
    else byte + 32 if chr(byte).isupper() else 32
    for byte in range(256))


# --- CRC-32 of concatenations -----------------------------------------------------------------

def _crc_tables() -> np.ndarray:
    """tables[k][i][b]: effect on a CRC of 2**k zero bytes after it, for value b of its byte i."""
    one = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
    first = np.zeros((4, 256), np.uint32)
    values = np.arange(256, dtype=np.uint32)
    first[0] = one
    for i in range(1, 4):
        first[i] = values << np.uint32(8 * (i - 1))
    tables = [first]
    for _ in range(31):
        last = tables[-1]
        tables.append(np.stack([_shift(_shift(values << np.uint32(8 * i), last), last)
                                for i in range(4)]))
    return np.stack(tables)


def _shift(crc: np.ndarray, table: np.ndarray) -> np.ndarray:
    out = table[0][crc & 255]
    for i in range(1, 4):
        out = out ^ table[i][(crc >> np.uint32(8 * i)) & 255]
    return out


_TABLES = _crc_tables()


def combined(left: np.ndarray, right: np.ndarray, right_bytes: np.ndarray) -> np.ndarray:
    """CRCs of the concatenations of texts known by their CRCs (unsigned 32 bits)."""
    out = left.astype(np.uint32)
    for k in range(int(right_bytes.max(initial=0)).bit_length()):
        chosen = (right_bytes >> k) & 1 == 1
        out[chosen] = _shift(out[chosen], _TABLES[k])
    return out ^ right.astype(np.uint32)


# --- scanning ----------------------------------------------------------------------------------

class Scanner:
    """Turns texts into feature buckets with the automaton of a dictionary."""

    def __init__(self, words: list[str], longest: int, buckets: int):
        self.longest, self.buckets = longest, buckets
        self.automaton = ahocorasick.Automaton()
        for word in words:
            raw = word.encode("utf-8")
            key = b" %b " % raw
            self.automaton.add_word(key.decode("latin-1"), len(raw) << 32 | zlib.crc32(raw))
        if words:
            self.automaton.make_automaton()
        self.empty = not words

    def words(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(CRC, length) of each word of a text, in order."""
        plain = b" %b " % (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN)
        blank = np.frombuffer(plain, np.uint8) == 32
        starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
        ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
        payloads = np.zeros(len(ends), np.int64)
        if not self.empty:
            found = list(self.automaton.iter(plain.decode("latin-1")))
            if len(found) == len(ends):
                payloads = np.array([payload for _, payload in found], np.int64)
            elif found:
                where, values = np.array(found, np.int64).T
                payloads[np.searchsorted(ends, where)] = values
        for i in np.flatnonzero(payloads == 0).tolist():
            raw = plain[starts[i]:ends[i]]
            payloads[i] = len(raw) << 32 | zlib.crc32(raw)
        return (payloads & 0xFFFFFFFF).astype(np.uint32), payloads >> 32

    def features(self, text: str | None) -> np.ndarray:
        """Bucket of every run of 1 to `longest` consecutive words, repeats included."""
        crcs, sizes = self.words(text)
        out = [crcs % self.buckets]
        runs = crcs
        spaced = combined(np.full(len(crcs), zlib.crc32(b" "), np.uint32), crcs, sizes)
        for extra in range(1, min(self.longest, len(crcs))):
            runs = combined(runs[:-1], spaced[extra:], sizes[extra:] + 1)
            out.append(runs % self.buckets)
        return np.concatenate(out).astype(np.int64)


_LOADED: dict[str, Scanner] = {}


def _loaded(name: str, sent: Broadcast) -> Scanner:
    """The scanner of a broadcast; a worker process builds it once and keeps the last one."""
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = Scanner(*sent.value)
    return _LOADED[name]


def frequent_words(texts: DataFrame, words: int = DICTIONARY_WORDS) -> list[str]:
    """The most frequent distinct words of a column `text`: at most `words`, none overlong."""
    lower = F.translate(F.col("text"), _CAPITALS, _CAPITALS.lower())
    found = F.explode(F.regexp_extract_all(lower, F.lit(_WORD), F.lit(0)))
    counted = texts.select(found.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    most = counted.where(F.octet_length("word") <= DICTIONARY_WORD_BYTES).orderBy(
        F.desc("n"), "word").limit(words)
    return most.select("word").toArrow()["word"].to_pylist()


def bucket_counts(texts: DataFrame, name: str, sent: Broadcast) -> DataFrame:
    """(bucket, n) over a column `text`; every task sends at most one row per bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _loaded(name, sent)
        total = np.zeros(scanner.buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += np.bincount(scanner.features(text.as_py()), minlength=scanner.buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    counts = texts.select("text").mapInArrow(run, "bucket bigint, n bigint")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def _gains(docs: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 * log ratio) of each bucket's smoothed share in the target and in the corpus."""
    found = docs.select("bucket", F.col("n").alias("s"), F.lit(0).cast("bigint").alias("t")).union(
        target.select("bucket", F.lit(0).cast("bigint"), "n")).groupBy("bucket").agg(
        F.sum("s").alias("s"), F.sum("t").alias("t"))
    table = found.toArrow()
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    at = table["bucket"].to_numpy()
    s[at], t[at] = table["s"].to_numpy(), table["t"].to_numpy()
    ratio = ((t + 1).astype(float) * float(s.sum() + buckets)) / (
        (s + 1).astype(float) * float(t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text",
          longest: int = 1, buckets: int = 10_000) -> DataFrame:
    """(key, n_features, weight) of every document: the sum of its features' gains.

    Features are all runs of 1 to `longest` words. Null and wordless texts have no features and
    weight 0; repeated rows each get a result; other columns are ignored, whatever their names; an
    empty corpus or target counts nothing and gives no row or gains of smoothing alone.
    """
    spark = docs.sparkSession
    corpus = docs.select(F.col(f"`{key}`").alias("key"),
                         F.col(f"`{text}`").cast("string").alias("text"))
    wanted = target.select(F.col(f"`{text}`").cast("string").alias("text"))
    words = frequent_words(corpus.select("text").union(wanted))
    sent = spark.sparkContext.broadcast((words, longest, buckets))
    name = f"{spark.sparkContext.applicationId}-{id(sent)}-{len(words)}"
    gains = spark.sparkContext.broadcast(_gains(
        bucket_counts(corpus, name, sent), bucket_counts(wanted, name, sent), buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, gain = _loaded(name, sent), gains.value
        for batch in batches:
            features = [scanner.features(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(f) for f in features], pa.int64()),
                 pa.array([int(gain[f].sum()) for f in features], pa.int64())],
                ["key", "n_features", "weight"])

    kind = corpus.schema["key"].dataType.simpleString()
    return corpus.mapInArrow(run, f"key {kind}, n_features bigint, weight bigint")


# --- drawing -----------------------------------------------------------------------------------

def noise(key: Column, seed: int) -> Column:
    """floor(1000 * Gumbel noise) that depends on the seed and the key alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
                    .cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    uniform = (h.cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("bigint")


def ranked(rows: DataFrame, order: list[Column], range_rows: int = RANGE_ROWS) -> DataFrame:
    """The rows of a stored table with `rank` 1, 2, ... in the given order, ties broken by value.

    Rows are dealt into ranges of the order and written down, so that counting a range and
    numbering its rows see the same rows; equal rows are told apart by a number of their own.
    """
    count = rows.count()
    ranges = max(1, -(-count // range_rows))
    own = stored(rows.withColumn("_own", F.monotonically_increasing_id()), "own")
    placed = stored(
        own.repartitionByRange(ranges, *order, F.col("_own")).withColumn(
            "_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row a range: small enough for one task.
    starts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order, "_own"))
    return placed.withColumn("_inside", inside).join(starts, "_range").withColumn(
        "rank", (F.col("_start") + F.col("_inside")).cast("bigint")).drop(
        "_own", "_range", "_inside", "_start")


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20,
             seed: int = 2024, key: str = "doc_id", text: str = "text", longest: int = 1,
             buckets: int = 10_000) -> DataFrame:
    """(key, n_features, weight, score, rank) of every document; rank is null where not drawn.

    Of the documents with at least `least_words` words, `percent` of 100 are drawn by the highest
    scores, ties to smaller keys (null keys first); equal rows share a score and follow each other.
    For nulls, empty texts and empty tables see weigh().
    """
    scored = weigh(docs, target, key, text, longest, buckets).withColumn(
        "score", F.col("weight") + noise(F.col("key"), seed))
    scored = stored(scored, "scores")
    # A text of w >= longest words has w + (w - 1) + ... features.
    least = sum(max(0, least_words - extra) for extra in range(longest))
    enough = F.col("n_features") >= least
    wanted = scored.where(enough).count() * percent // 100
    numbered = ranked(scored.where(enough), [F.desc("score"), F.asc("key")])
    drawn = F.when(F.col("rank") <= wanted, F.col("rank"))
    columns = [F.col("key").alias(key), "n_features", "weight", "score"]
    return numbered.select(*columns, drawn.alias("rank")).union(
        scored.where(~enough).select(*columns, F.lit(None).cast("bigint")))
