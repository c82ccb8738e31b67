"""Frequent phrases of each language, mined by partitioning (SON).

A phrase that occurs often enough in a whole language occurs proportionally often in at least one of
the shards the language is dealt over. So every shard, a fixed share of the texts, is mined completely
at its share of the support: first its pairs of words, then the longer phrases, in which every pair
of neighbours has to be a candidate. What is frequent in some shard is a candidate, and the exact
recount of a candidate adds up what all shards counted of it: a shard counts every phrase whose pairs
are candidates anywhere, so no further scan of the texts is needed. Candidate pairs travel to the
second scan as a filter of fixed size (a Bloom filter, bits joined by OR). A pair that passes by
mistake is frequent in no longer phrase either, so the filter's size changes no result, only the work.

A shard is no task: tasks count the phrases of the shards in runs of texts of bounded size, and Spark
adds the counts up by shard. The number of shards is fixed, so local supports do not fall as the corpus
grows. A phrase is shuffled as the numbers of its words in the list of its language's frequent words,
a few bytes a word, which is exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.shared import stored

#: Shards of each language.
SHARDS = 4
#: Bytes of text in a run, a single longer text aside.
RUN_BYTES = 16_000_000
#: Rows that a task hands over at a time.
BATCH_ROWS = 20_000
#: Keys of phrases, a few bytes each, handed over at a time.
KEY_ROWS = 100_000
#: Bits of a filter: 8 MB, whatever the corpus.
FILTER_BITS = 1 << 26
#: Languages whose totals may be broadcast.
MAX_LANGUAGES = 100_000
#: Rows that one task ranks before the final ranking.
RANK_ROWS = 50_000

_BREAK = b"\n"
# Capitals become small, tabs blanks, and the marks that end a piece line feeds.
_PLAIN = bytes(
    byte + 32 if 65 <= byte <= 90 else 32 if byte == 9
    else 10 if byte in b".,;:!?" or 10 <= byte <= 13 else byte
    for byte in range(256))


class Run:
    """The words of one language's shard in a run of texts, as numbers; 0 ends a piece."""

    def __init__(self, lang: str, shard: int):
        self.lang, self.shard = lang, shard
        self.names: dict[bytes, int] = {_BREAK: 0}
        self.parts: list[np.ndarray] = []

    def add(self, raw: bytes) -> None:
        names = self.names
        found = raw.translate(_PLAIN).replace(_BREAK, b" \n ").split(b" ")
        self.parts.append(np.array(
            [names.setdefault(word, len(names)) for word in found if word] + [0], np.int32))

    def close(self) -> None:
        self.ids = np.concatenate(self.parts)
        self.words = list(self.names)
        self.size = int(np.count_nonzero(self.ids))
        del self.parts, self.names


def runs(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[Run]:
    """Runs of (lang, shard, text) rows, each split by language and shard."""
    open_: dict[tuple[str, int], Run] = {}
    size = 0

    def closed() -> Iterator[Run]:
        for key in list(open_):
            run = open_.pop(key)
            run.close()
            yield run

    for batch in batches:
        for *key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                              batch.column(2)):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
            run = open_.get(tuple(key))
            if run is None:
                run = open_[tuple(key)] = Run(*key)
            run.add(raw)
            size += len(raw)
            if size >= limit:
                yield from closed()
                size = 0
    yield from closed()


# --- the filter of fixed size ------------------------------------------------------------------

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def joined_hash(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase followed by a word."""
    value = phrase * _FACTOR + word
    return (value ^ (value >> np.uint64(29))) * _FACTOR


def pair_hashes(part: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of pairs of words of a language, all given by number."""
    head = joined_hash(np.full(len(left), part + 1, np.uint64), left.astype(np.uint64))
    return joined_hash(head, right.astype(np.uint64))


def _places(hashes: np.ndarray) -> np.ndarray:
    """Two bits of the filter for each hash."""
    mask = np.uint64(FILTER_BITS - 1)
    return np.stack([hashes & mask, (hashes * _FACTOR >> np.uint64(38)) & mask])


def mark(bits: np.ndarray, hashes: np.ndarray) -> None:
    places = _places(hashes).ravel()
    np.bitwise_or.at(bits, places >> np.uint64(6), np.uint64(1) << (places & np.uint64(63)))


def marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    places = _places(hashes)
    return (((bits[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1)) == 1).all(
        axis=0)


def _no_bits() -> np.ndarray:
    return np.zeros(FILTER_BITS // 64, np.uint64)


def _united(marks: Callable, rows: DataFrame) -> np.ndarray:
    """The OR of the filters of all tasks: at most FILTER_BITS / 64 numbers reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = _no_bits()
        for hashes in marks(batches):
            mark(bits, hashes)
        used = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(bits[used].view(np.int64))], ["at", "bits"])

    found = rows.mapInArrow(run, "at bigint, bits bigint").groupBy("at").agg(
        F.bit_or("bits").alias("bits")).toArrow()
    bits = _no_bits()
    bits[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return bits


# --- mining ------------------------------------------------------------------------------------

def numbered(run: Run, frequent: pa.Array) -> np.ndarray:
    """The number of the frequent word at each place of a run, -1 where there is none."""
    found = pc.index_in(pa.array(run.words, pa.binary()), value_set=frequent)
    return found.fill_null(-1).to_numpy(zero_copy_only=False)[run.ids]


def levels(ids: np.ndarray, many: int, longest: int,
           keep: Callable) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words, place, count) of the phrases of a run that are kept, level by level.

    `ids` are numbers below `many` (-1: none), `place` is where a phrase occurs. keep(words, places)
    decides on the phrases of a level; only phrases whose two longest parts were kept are looked at.
    """
    names = ids
    for k in range(2, longest + 1):
        at = np.flatnonzero((names[:-1] >= 0) & (names[1:] >= 0))
        at = at[at + k - 1 < len(ids)]
        if not len(at):
            return
        key = names[at].astype(np.int64) * many + ids[at + k - 1]
        names = np.full(len(ids), -1, np.int32)
        order = np.argsort(key)
        key = key[order]
        new = np.append(True, key[1:] != key[:-1])
        starts = np.flatnonzero(new)
        counts = np.diff(starts, append=len(key))
        first = at[order[starts]]
        del key
        kept = keep(k, first)
        numbers = np.cumsum(new, dtype=np.int32) - np.int32(1)
        names[at[order]] = np.where(kept[numbers], numbers, np.int32(-1))
        del at, order, new, numbers
        yield k, first[kept], counts[kept]


def packed(ids: np.ndarray, places: np.ndarray, words: int, width: int) -> pa.Array:
    """The numbers of the `words` words from each place on, as `width` bytes each."""
    whole = ids[places[:, None] + np.arange(words)].astype(">u4").view(np.uint8)
    short = np.ascontiguousarray(whole.reshape(len(places), words, 4)[:, :, 4 - width:])
    offsets = np.arange(len(places) + 1, dtype=np.int32) * np.int32(words * width)
    return pa.Array.from_buffers(
        pa.binary(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(short)])


def unpacked(keys: list[bytes], width: int) -> np.ndarray:
    """The numbers in all the keys, one after the other."""
    short = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, width)
    whole = np.zeros((len(short), 4), np.uint8)
    whole[:, 4 - width:] = short
    return whole.view(">u4").ravel().astype(np.int64)


def _local_support(support: int, part: int, whole: int) -> int:
    """The least count that some shard of a phrase with `support` occurrences reaches."""
    return -(-support * part // whole)


def _word_counts(texts: DataFrame, run_bytes: int) -> DataFrame:
    """(lang, shard, word, n): n of each word of a language (no shard), and of all words of a shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, run_bytes):
            counts = np.bincount(part.ids, minlength=len(part.words))
            counts[0] = part.size
            for start in range(0, len(counts), BATCH_ROWS):
                rows = slice(start, start + BATCH_ROWS)
                words = [w.decode("utf-8", "replace") for w in part.words[rows]]
                shards = [None] * len(words)
                if not start:
                    words[0], shards[0] = None, part.shard
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.lang] * len(words)), pa.array(shards, pa.int32()),
                     pa.array(words, pa.string()), pa.array(counts[rows])],
                    ["lang", "shard", "word", "n"])

    return texts.mapInArrow(run, "lang string, shard int, word string, n bigint").groupBy(
        "lang", "shard", "word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """The frequent words of each language, numbered from 0, and the number of the language."""

    def __init__(self, langs: list[str], rows: pa.Table):
        self.parts = {lang: part for part, lang in enumerate(langs)}
        lang, word = (rows[name].cast(kind) for name, kind in (
            ("lang", pa.string()), ("word", pa.binary())))
        self.words = [word.filter(pc.equal(lang, name)).combine_chunks() for name in langs]
        most = max(map(len, self.words), default=0)
        #: Bytes of a word's number.
        self.width = max(1, (max(most - 1, 0).bit_length() + 7) // 8)


def _all_pass(hashes: np.ndarray) -> np.ndarray:
    return np.ones(len(hashes), bool)


def _mined(texts: DataFrame, known: Broadcast, sizes: tuple[int, int], supports: DataFrame,
           support: int, shards: int, run_bytes: int) -> DataFrame:
    """(part, key, a) of the phrases of first..last words: frequent in some shard, and in all.

    known holds the vocabulary and the filter of the pairs that longer phrases consist of;
    `supports` holds (part, least), the least count in each shard of a language.
    """
    first, last = sizes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, pairs = known.value
        for text in runs(batches, run_bytes):
            part = vocabulary.parts.get(text.lang)
            if part is None:
                continue
            frequent = vocabulary.words[part]
            ids = numbered(text, frequent)

            def keep(k: int, places: np.ndarray, part=part, ids=ids) -> np.ndarray:
                if k >= first:
                    return _all_pass(places)
                return marked(pairs, pair_hashes(part, ids[places], ids[places + 1]))

            for k, places, counts in levels(ids, len(frequent), last, keep):
                for start in range(0, len(counts) if k >= first else 0, KEY_ROWS):
                    rows = slice(start, start + KEY_ROWS)
                    keys = packed(ids, places[rows], k, vocabulary.width)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys), part, np.int32)), keys,
                         pa.array(np.full(len(keys), text.shard, np.int32)),
                         pa.array(counts[rows].astype(np.int32))],
                        ["part", "key", "shard", "n"])

    counted = texts.mapInArrow(run, "part int, key binary, shard int, n int").groupBy(
        "part", "key").agg(*(
            F.sum(F.when(F.col("shard") == i, F.col("n")).otherwise(0)).alias(f"n_{i}")
            for i in range(shards)))
    # One row a language, whose number was checked.
    local = counted.join(F.broadcast(supports), "part").where(
        " or ".join(f"n_{i} >= least[{i}]" for i in range(shards)))
    return local.select("part", "key", sum(F.col(f"n_{i}") for i in range(shards)).alias("a")).where(
        F.col("a") >= support)


def _pair_filter(pairs: DataFrame, width: int) -> np.ndarray:
    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            parts = batch.column(0).to_numpy()
            ids = unpacked(batch.column(1).to_pylist(), width).reshape(-1, 2)
            for part in np.unique(parts).tolist():
                of_part = ids[parts == part]
                yield pair_hashes(part, of_part[:, 0], of_part[:, 1])

    return _united(marks, pairs.select("part", "key"))


def _spelled(mined: DataFrame, known: Broadcast) -> DataFrame:
    """(lang, phrase, a) of (part, key, a)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, _ = known.value
        langs, width = list(vocabulary.parts), vocabulary.width
        for batch in batches:
            parts = batch.column(0).to_numpy()
            for part in np.unique(parts).tolist():
                rows = batch.filter(pa.array(parts == part))
                keys = rows.column(1).to_pylist()
                words = iter(vocabulary.words[part].take(
                    pa.array(unpacked(keys, width))).to_pylist())
                phrases = [b" ".join(next(words) for _ in range(len(key) // width))
                           for key in keys]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([langs[part]] * len(keys), pa.string()),
                     pa.array(phrases, pa.binary()).cast(pa.string()), rows.column(2)],
                    ["lang", "phrase", "a"])

    return mined.mapInArrow(run, "lang string, phrase string, a bigint")


def frequent_phrases(docs: DataFrame, support: int, longest: int, lang: str, text: str,
                     shards: int = SHARDS,
                     run_bytes: int = RUN_BYTES) -> tuple[DataFrame, DataFrame]:
    """Stored tables (lang, word, n) and (lang, phrase, a) of all with at least `support`.

    The first also has a row with a null word for each language: the number of all its words.
    """
    spark = docs.sparkSession
    text_column = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    texts = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
        F.pmod(F.xxhash64(text_column), F.lit(shards)).cast("int").alias("shard"),
        text_column.alias("text"))
    found = stored(_word_counts(texts, run_bytes).where(
        (F.col("n") >= support) | F.col("word").isNull()), "words")
    words = found.where("word is not null").select("lang", "word", "n").union(
        found.where("word is null").groupBy("lang").agg(F.sum("n").alias("n")).select(
            "lang", F.lit(None).cast("string").alias("word"), "n"))
    # A shard without words has no phrases, and a language with fewer words than the support none.
    whole = words.where("word is null").where(F.col("n") >= support).select(
        "lang", F.col("n").alias("whole"))
    sizes = found.where("word is null and n > 0").join(whole, "lang").limit(
        MAX_LANGUAGES * shards + 1).collect()
    if len(sizes) > MAX_LANGUAGES * shards:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts: dict[str, dict[int, int]] = {}
    for r in sizes:
        counts.setdefault(r["lang"], {})[r["shard"]] = r["n"]
    wholes = {r["lang"]: r["whole"] for r in sizes}
    vocabulary = Vocabulary(list(counts), words.where("word is not null").select(
        "lang", "word").toArrow())
    # A shard without words counts nothing, so that any least count will do for it.
    supports = spark.createDataFrame(
        [(vocabulary.parts[of_lang], [
            _local_support(support, held.get(i, wholes[of_lang]), wholes[of_lang])
            for i in range(shards)]) for of_lang, held in counts.items()],
        "part int, least array<bigint>")
    known = spark.sparkContext.broadcast((vocabulary, None))
    mined = spark.createDataFrame([], "part int, key binary, a bigint")
    for reach in ((2, 2), (3, longest)):
        if reach[0] <= longest:
            if reach[0] > 2:
                known = spark.sparkContext.broadcast(
                    (vocabulary, _pair_filter(mined, vocabulary.width)))
            mined = mined.union(stored(
                _mined(texts, known, reach, supports, support, shards, run_bytes), "mined"))
    return words, stored(_spelled(mined, known), "phrases")


# --- scores ------------------------------------------------------------------------------------

def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def _scored(words: DataFrame, phrases: DataFrame, chosen: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of chosen phrases by their lowest cut, then smallest k."""
    parts = words.where("word is not null").select("lang", F.col("word").alias("part"), "n").union(
        phrases)
    split = chosen.withColumn("w", F.split("phrase", " ")).select(
        "lang", "phrase", "a", "w",
        F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = split.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("tail"))
    totals = words.where("word is null").select("lang", F.col("n").alias("total"))
    met = cuts.join(parts.select("lang", F.col("part").alias("head"), F.col("n").alias("l")),
                    ["lang", "head"]).join(
        parts.select("lang", F.col("part").alias("tail"), F.col("n").alias("r")),
        ["lang", "tail"]).join(totals, "lang")
    met = met.select("lang", "phrase", "k", "total", *(
        _exact(name).alias(name) for name in ("a", "l", "r"))).withColumn(
        "score", F.expr("(1000bd * a * cast(total as decimal(19,0))) div (l * r)"))
    best = met.groupBy("lang", "phrase", F.col("total").alias("n")).agg(
        F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", *(
        F.col(f"cut.{name}").cast("bigint").alias(name) for name in ("a", "l", "r")), "n",
        "cut.score")


def _not_absorbed(phrases: DataFrame, percent: int) -> DataFrame:
    """Phrases without a longer one around them that occurs at least `percent` of 100 as often."""
    split = phrases.withColumn("w", F.split("phrase", " ")).where(F.size("w") > 2)
    inner = split.withColumn("size", F.explode(F.sequence(F.lit(2), F.size("w") - 1))).select(
        "lang", "a", "w", "size",
        F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)).alias("at"))
    around = inner.select(
        "lang", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase"),
        "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    joined = phrases.join(around, ["lang", "phrase"], "left")
    return joined.where("longer is null or 100 * longer < {0} * a".format(int(percent))).drop(
        "longer")


def _first(rows: DataFrame, limit: int) -> DataFrame:
    """The first rows of each language, ranked from 1; hashed buckets are cut before the ranking."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    buckets = max(1, -(-rows.count() // RANK_ROWS))
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(buckets))).orderBy(*order)
    short = rows.withColumn("_place", F.row_number().over(part)).where(F.col("_place") <= limit)
    whole = Window.partitionBy("lang").orderBy(*order)
    return short.withColumn("rank", F.row_number().over(whole).cast("bigint")).where(
        F.col("rank") <= limit).drop("_place")


def collocations(docs: DataFrame, support: int = 100, longest: int = 5, percent: int = 100,
                 limit: int = 2000, lang: str = "lang", text: str = "text", shards: int = SHARDS,
                 run_bytes: int = RUN_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first phrases of 2 to `longest` words.

    A null language is `und`, null and empty texts have no words, repeated rows count each time,
    other columns are ignored whatever their names, an empty table gives nothing. Phrases inside a
    longer one that is (at `percent` of 100) as frequent are left out.
    """
    words, phrases = frequent_phrases(docs, support, longest, lang, text, shards, run_bytes)
    scored = stored(_scored(words, phrases, _not_absorbed(phrases, percent)), "scored")
    return _first(scored, limit).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
