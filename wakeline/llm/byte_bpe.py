"""Byte-level byte-pair encoding and decoding.

A text is cut into words by the tokenizer's pattern. The distinct words of the corpus are counted,
and the most frequent of them are encoded by Spark's higher-order functions: the ranked merges are
folded over a word's array of byte tokens, every step merging the leftmost pair of the lowest rank,
found in a literal rank map, until no pair has a rank. They reach the documents as a broadcast of
bounded size. A word beyond that bound is folded by the same rule in the task that meets it, so the
bound changes no result. Decoding concatenates the byte strings of the ids. No text is shuffled.

The id of a token is its rank. A merge is allowed where the concatenation of both byte strings is a
token, however that token came about. White space in the pattern is Unicode's White_Space.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.llm.bpe import Bounded
from wakeline.llm.shared import columns_in_one

#: Distinct words encoded ahead, at most, and the bytes of the longest of them.
LEXICON_WORDS = 65_536
LEXICON_WORD_BYTES = 48
#: Entries of a literal map that are searched one after the other.
ENTRIES_A_MAP = 6
CACHE_ENTRIES = 200_000
#: Characters of text that a task holds at a time, single longer texts aside.
SLICE_CHARS = 2_000_000

_NONE = 2**31 - 1  # above every rank

# The characters with the property White_Space, as a character class.
_SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and ranks of a rank file (base64 text and number a line)."""
    with open(path, "rb") as file:
        pairs = (line.split() for line in file if line.strip())
        return {base64.b64decode(text): int(rank) for text, rank in pairs}


def merge_ranks(ranks: dict[bytes, int]) -> dict[tuple[int, int], int]:
    """The rank of every pair of tokens whose concatenation is a token."""
    return {
        (ranks[token[:cut]], ranks[token[cut:]]): rank
        for token, rank in ranks.items() for cut in range(1, len(token))
        if token[:cut] in ranks and token[cut:] in ranks
    }


def _literal(value, kind: str) -> Column:
    """A constant of a nested type; the optimizer folds the parser away."""
    return F.from_json(F.lit(json.dumps(value, ensure_ascii=False)), kind)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


class _PairRanks:
    """The literal map from a pair of ids to its rank, dealt over short maps."""

    def __init__(self, merges: dict[tuple[int, int], int], size: int):
        self.size = size
        self.buckets = max(1, len(merges) // ENTRIES_A_MAP)
        maps: list[dict[str, int]] = [{} for _ in range(self.buckets)]
        for (left, right), rank in merges.items():
            key = left * size + right
            maps[key % self.buckets][str(key)] = rank
        self.maps = _literal(maps, "array<map<string, int>>")

    def of(self, left: Column, right: Column) -> Column:
        key = left.cast("bigint") * self.size + right.cast("bigint")
        bucket = F.get(self.maps, (key % self.buckets).cast("int"))
        return F.coalesce(F.try_element_at(bucket, key.cast("string")), F.lit(_NONE))


class WordFold:
    """The fold of one vocabulary as column expressions."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = "(?U)" + pattern
        self.pairs = _PairRanks(merge_ranks(ranks), max(ranks.values()) + 1)
        self.byte_ids = [ranks[bytes([byte])] for byte in range(256)]

    def words(self, text: Column) -> Column:
        """All matches of the pattern, in order; a null text has none."""
        return F.regexp_extract_all(
            F.coalesce(text.cast("string"), F.lit("")), F.lit(self.pattern), F.lit(0))

    def bytes_of(self, word: Column) -> Column:
        """The token ids of a word's single bytes."""
        digits = F.hex(word.cast("binary"))
        places = F.sequence(F.lit(1), F.length(digits), F.lit(2))
        table = _literal(self.byte_ids, "array<int>")
        return F.transform(places, lambda at: F.get(
            table, F.conv(F.substring(digits, at, F.lit(2)), 16, 10).cast("int")))

    def fold(self, word: Column) -> Column:
        """Ids of one non-empty word: all its merges, lowest rank first, leftmost of equal ones."""
        start = self.bytes_of(word)
        following = F.concat(F.slice(start, F.lit(2), F.size(start)), F.array(F.lit(-1)))
        ranks = F.zip_with(start, following, self._rank)
        state = F.struct(start.alias("ids"), ranks.alias("ranks"))
        steps = F.sequence(F.lit(2), F.greatest(F.octet_length(word), F.lit(2)))
        return F.aggregate(steps, state, lambda state, _: self._step(state)).getField("ids")

    def _rank(self, left: Column, right: Column) -> Column:
        return F.when(right < 0, F.lit(_NONE)).otherwise(self.pairs.of(left, right))

    def _step(self, state: Column) -> Column:
        """One merge. The ranks of the pairs left and right of it are looked up anew."""
        ranks = state.getField("ranks")
        least = F.array_min(ranks)
        return F.when(least == _NONE, state).otherwise(_bound(least, lambda rank: _bound(
            F.array_position(ranks, rank).cast("int"),
            lambda at: self._merged(state.getField("ids"), ranks, rank, at))))

    def _merged(self, ids: Column, ranks: Column, rank: Column, at: Column) -> Column:
        count = F.size(ids)
        before, after = F.get(ids, at - 2), F.coalesce(F.get(ids, at + 1), F.lit(-1))
        around = F.transform(
            F.array(F.struct(F.coalesce(before, F.lit(-1)).alias("l"), rank.alias("r")),
                    F.struct(rank.alias("l"), after.alias("r"))),
            lambda pair: self._rank(pair.getField("l"), pair.getField("r")))
        return F.struct(
            F.concat(F.slice(ids, F.lit(1), at - 1), F.array(rank),
                     F.slice(ids, at + 2, count)).alias("ids"),
            F.concat(
                F.slice(ranks, F.lit(1), F.greatest(at - 2, F.lit(0))),
                F.slice(around, F.when(at > 1, F.lit(1)).otherwise(F.lit(2)), F.lit(2)),
                F.slice(ranks, at + 2, count)).alias("ranks"))

    def lexicon(self, docs: DataFrame, text: str, words: int) -> dict[str, bytes]:
        """Packed ids of the corpus's most frequent words, each folded once; at most `words`."""
        counted = docs.select(F.explode(self.words(F.col(f"`{text}`"))).alias("word")).groupBy(
            "word").agg(F.count(F.lit(1)).alias("n"))
        most = counted.where(F.octet_length("word") <= LEXICON_WORD_BYTES).orderBy(
            F.desc("n"), "word").limit(words)
        # Dealt over all cores; without that the optimizer would fold a local relation itself.
        spark = docs.sparkSession
        found = spark.createDataFrame(most.select("word").toArrow()).repartition(
            spark.sparkContext.defaultParallelism)
        rows = found.select("word", self.fold(F.col("word")).alias("ids")).toArrow()
        return {word: pack(ids) for word, ids in zip(rows["word"].to_pylist(),
                                                     rows["ids"].to_pylist())}


def pack(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit numbers."""
    return np.array(ids, "<u4").tobytes()


class ByteBpe:
    """Encoder and decoder of one vocabulary inside a task."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, lexicon: dict[str, bytes]):
        inside = pattern.replace(r"[^\s", f"[^{_SPACE}")
        self.pattern = regex.compile(
            inside.replace(r"\S", f"[^{_SPACE}]").replace(r"\s", f"[{_SPACE}]"))
        self.ranks = ranks
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.pieces[rank] = token
        self.lexicon = lexicon
        self.others = Bounded(self.fold, CACHE_ENTRIES)

    def fold(self, word: str) -> bytes:
        """As WordFold.fold: the pending merges wait in a queue, a changed pair's entry is stale."""
        raw = word.encode("utf-8", "surrogatepass")
        ends = list(range(1, len(raw) + 1))  # where the token that starts here ends; 0: none does
        before = list(range(-1, len(raw) - 1))
        ranks, queue = self.ranks, []

        def offer(left: int) -> None:
            right = ends[left]
            if right < len(raw):
                rank = ranks.get(raw[left:ends[right]])
                if rank is not None:
                    heapq.heappush(queue, (rank, left, right, ends[right]))

        for left in range(len(raw) - 1):
            offer(left)
        while queue:
            _, left, right, end = heapq.heappop(queue)
            if ends[left] != right or ends[right] != end:
                continue
            ends[left], ends[right] = end, 0
            if end < len(raw):
                before[end] = left
            if before[left] >= 0:
                offer(before[left])
            offer(left)
        return pack([ranks[raw[at:end]] for at, end in enumerate(ends) if end])

    def encode(self, text: str | None) -> bytes:
        """Packed ids of a whole text; null is empty."""
        known, others = self.lexicon.get, self.others
        return b"".join([known(word) or others[word] for word in self.pattern.findall(text or "")])

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


_LOADED: dict[str, ByteBpe] = {}


def _loaded(name: str, sent: Broadcast) -> ByteBpe:
    """The encoder of a broadcast; a worker process builds it once and keeps the last one."""
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = ByteBpe(*sent.value)
    return _LOADED[name]


def _mapper(docs: DataFrame, rank_path: str, pattern: str, text: str, words: int,
            keep: list[str] | None, outputs: Callable) -> tuple[DataFrame, Callable]:
    """The rows and their mapInArrow function: (row, *outputs of packed ids and decoded bytes)."""
    ranks = read_ranks(rank_path)
    if any(bytes([byte]) not in ranks for byte in range(256)):
        raise ValueError("the vocabulary lacks single bytes")
    lexicon = WordFold(ranks, pattern).lexicon(docs, text, words)
    sent = docs.sparkSession.sparkContext.broadcast((ranks, pattern, lexicon))
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(name, sent)
        for batch in batches:
            for part in _slices(batch):
                ids = [bpe.encode(value) for value in part.column(1).to_pylist()]
                decoded = [bpe.decode(np.frombuffer(i, "<u4").tolist()) for i in ids]
                columns = outputs(ids, decoded)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *columns.values()], names=["row", *columns])

    rows = docs.select(columns_in_one(docs, keep).alias("row"),
                       F.col(f"`{text}`").cast("string").alias("text"))
    return rows, run


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about SLICE_CHARS of text each."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0))
    group = np.cumsum(sizes, dtype=np.int64) // SLICE_CHARS
    starts = np.flatnonzero(np.diff(group, prepend=-1)) if len(group) else []
    for at, end in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(at, end - at)


def encode_and_decode(docs: DataFrame, rank_path: str, pattern: str, text: str = "text",
                      keep: list[str] | None = None,
                      words: int = LEXICON_WORDS) -> DataFrame:
    """(row, ids, decoded) of every document; row holds its columns (or `keep`), decoded is binary.

    Null and empty texts have no ids and decode to no bytes. Repeated rows each get a result,
    columns may have any name, an empty table gives an empty result.
    """
    def outputs(ids: list[bytes], decoded: list[bytes]) -> dict[str, pa.Array]:
        offsets = np.zeros(len(ids) + 1, np.int32)
        np.cumsum([len(i) // 4 for i in ids], out=offsets[1:])
        flat = np.frombuffer(b"".join(ids), "<i4")
        return {"ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                "decoded": pa.array(decoded, pa.binary())}

    rows, run = _mapper(docs, rank_path, pattern, text, words, keep, outputs)
    return rows.mapInArrow(run, T.StructType([
        rows.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.BinaryType())]))


def token_digests(docs: DataFrame, rank_path: str, pattern: str, key: str = "doc_id",
                  text: str = "text", words: int = LEXICON_WORDS) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every document, the last from its ids."""
    def outputs(ids: list[bytes], decoded: list[bytes]) -> dict[str, pa.Array]:
        return {"n_tokens": pa.array([len(i) // 4 for i in ids], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
                "decoded_sha256": pa.array([hashlib.sha256(d).hexdigest() for d in decoded])}

    rows, run = _mapper(docs, rank_path, pattern, text, words, [key], outputs)
    coded = rows.mapInArrow(run, T.StructType([
        rows.schema["row"], T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType())]))
    return coded.select(F.col("row").getField(key).alias(key), "n_tokens", "ids_sha256",
                        "decoded_sha256")
