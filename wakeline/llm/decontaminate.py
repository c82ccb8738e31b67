"""Benchmark passages in documents, by a prefix-filtered set join with exact verification.

A benchmark item is cut into windows of `window` words (a shorter item is one window). The elements
of a window are its word shingles. Shingles are ordered by how often they occur in all documents;
for exact containment the necessary prefix of a window is its rarest shingle alone, so a document is
compared with a window only where that shingle occurs. The shingle's place in the window gives the
only possible position, the window must fit into the document's length there, and the words are then
compared one by one.

The benchmark is handled in chunks of bounded size; the documents never leave their partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.llm.shared import bytes_or_empty, columns_in_one, stored

WINDOW = 10
SHINGLE = 3
#: Benchmark text indexed at a time; this is what the driver and each task hold.
CHUNK_BYTES = 2_000_000
#: Documents handled at a time inside a task.
SLICE_ROWS = 500

# A word is a run of digits, letters a-z (after lower-casing A-Z) and bytes above 0x7F.
_KEPT = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A
    else byte if 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A or byte >= 0x80
    else 0x20
    for byte in range(256)
)
_ID_BITS = 21
_STATE = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
          T.StructField("spans", T.BinaryType()),
          T.StructField("items", T.ArrayType(T.StringType()))]


def words_of(text: str | None) -> list[bytes]:
    return bytes_or_empty(text).translate(_KEPT).split()


class Shingles:
    """The words of a benchmark chunk, its windows, and the shingles of each window."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int, width: int):
        self.vocabulary: dict[bytes, int] = {}
        self.width = width
        seen: dict[tuple[int, ...], int] = {}
        self.windows: list[tuple[int, ...]] = []
        self.items: list[set[str]] = []
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
                   for word in words_of(text)]
            size = min(window, len(ids))
            for start in range(len(ids) - size + 1 if size else 0):
                words = tuple(ids[start:start + size])
                number = seen.setdefault(words, len(seen))
                if number == len(self.windows):
                    self.windows.append(words)
                    self.items.append(set())
                if item_id is not None:
                    self.items[number].add(item_id)
        if len(self.vocabulary) >= 1 << _ID_BITS:
            raise ValueError("benchmark chunk holds too many different words")
        self.lengths = np.array([len(w) for w in self.windows], np.int64)
        self.codes = [self.window_codes(words) for words in self.windows]
        self.widths = sorted({min(width, len(w)) for w in self.windows})
        self.distinct = np.unique(np.concatenate(self.codes) if self.codes
                                  else np.empty(0, np.int64))

    def window_codes(self, words: tuple[int, ...]) -> np.ndarray:
        return codes_of(np.array(words, np.int64), min(self.width, len(words)))

    def ids(self, words: list[bytes]) -> np.ndarray:
        """Numbers of a document's words; 0 for words no item has."""
        get = self.vocabulary.get
        return np.fromiter((get(word, 0) for word in words), np.int64, len(words))

    def found(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place among the distinct shingles, word position) of each benchmark shingle."""
        places, positions = [], []
        for width in self.widths:
            if len(ids) < width:
                continue
            inside = ids > 0
            whole = inside[: len(ids) - width + 1].copy()
            for step in range(1, width):
                whole &= inside[step:len(ids) - width + 1 + step]
            at = np.flatnonzero(whole)
            if not len(at):
                continue
            codes = np.zeros(len(at), np.int64)
            for step in range(width):
                codes |= ids[at + step] << (_ID_BITS * (2 - step))
            place = np.searchsorted(self.distinct, codes)
            place[place == len(self.distinct)] = 0
            known = self.distinct[place] == codes
            places.append(place[known])
            positions.append(at[known])
        if not places:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(places), np.concatenate(positions)


def codes_of(ids: np.ndarray, width: int) -> np.ndarray:
    """Shingles of up to three words as one number each; exact, no hashing."""
    n = len(ids) - width + 1
    codes = np.zeros(max(n, 0), np.int64)
    for step in range(width):
        codes |= ids[step:step + n] << (_ID_BITS * (2 - step))
    return codes


class PrefixIndex:
    """For each window its rarest shingle, and for each such shingle the windows and offsets."""

    def __init__(self, shingles: Shingles, counts: dict[int, int]):
        self.shingles = shingles
        rarity = np.array([counts.get(code, 0) for code in shingles.distinct.tolist()], np.int64)
        entries: dict[int, list[tuple[int, int]]] = {}
        for number, codes in enumerate(shingles.codes):
            places = np.searchsorted(shingles.distinct, codes)
            offset = int(np.lexsort((places, rarity[places]))[0])
            entries.setdefault(int(places[offset]), []).append((number, offset))
        sizes = np.zeros(len(shingles.distinct) + 1, np.int64)
        for place, found in entries.items():
            sizes[place + 1] = len(found)
        self.first = np.cumsum(sizes)
        flat = [entry for place in sorted(entries) for entry in entries[place]]
        pairs = np.array(flat, np.int64).reshape(-1, 2)
        self.window, self.offset = pairs[:, 0], pairs[:, 1]
        longest = int(shingles.lengths.max()) if len(shingles.lengths) else 0
        self.words = np.zeros((len(shingles.windows), longest), np.int64)
        for number, words in enumerate(shingles.windows):
            self.words[number, : len(words)] = words

    def matches(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, first word position) of every occurrence in a document."""
        place, position = self.shingles.found(ids)
        fan = self.first[place + 1] - self.first[place] if len(place) else place
        owner = np.repeat(np.arange(len(place)), fan)
        entry = np.arange(int(fan.sum())) - np.repeat(np.cumsum(fan) - fan, fan)
        entry += self.first[place[owner]] if len(owner) else 0
        window = self.window[entry]
        start = position[owner] - self.offset[entry]
        length = self.shingles.lengths[window]
        fits = (start >= 0) & (start + length <= len(ids))
        window, start, length = window[fits], start[fits], length[fits]
        for step in range(self.words.shape[1]):
            if not len(window):
                break
            inside = step < length
            at = np.where(inside, start + step, 0)
            same = ~inside | (ids[at] == self.words[window, step])
            window, start, length = window[same], start[same], length[same]
        return window, start


def covered(spans: np.ndarray) -> np.ndarray:
    """Disjoint (first, end) ranges that cover what the given ranges cover, in order."""
    if len(spans) < 2:
        return spans
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    opens = np.append(True, spans[1:, 0] > reach[:-1])
    ends = np.append(np.flatnonzero(opens)[1:], len(spans)) - 1
    return np.stack([spans[opens, 0], reach[ends]], axis=1)


def _count_shingles(docs: DataFrame, text: str, shingles) -> dict[int, int]:
    """Occurrences of the chunk's shingles in all documents; as many numbers as it has shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shingles.value
        total = np.zeros(len(known.distinct), np.int64)
        for batch in batches:
            for value in batch.column(0):
                place, _ = known.found(known.ids(words_of(value.as_py())))
                total += np.bincount(place, minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(known.distinct[used]), pa.array(total[used])], names=["code", "n"])

    counted = docs.select(text).mapInArrow(run, "code bigint, n bigint")
    found = counted.groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    return dict(zip(found["code"].to_pylist(), found["n"].to_pylist()))


def _mark(rows: DataFrame, index) -> DataFrame:
    """Add one chunk's occurrences to the state columns of (row, text, state...)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: PrefixIndex = index.value
        lengths, items = known.shingles.lengths, known.shingles.items
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                n_words, n_hit, spans_out, items_out = [], [], [], []
                for text, spans, names in zip(*(batch.column(name).to_pylist()
                                                for name in ("text", "spans", "items"))):
                    words = words_of(text)
                    window, start = known.matches(known.shingles.ids(words))
                    old = np.frombuffer(spans, "<i8").reshape(-1, 2)
                    new = np.stack([start, start + lengths[window]], axis=1)
                    spans = covered(np.concatenate([old, new]))
                    for number in np.unique(window).tolist():
                        names = {*names, *items[number]}
                    n_words.append(len(words))
                    n_hit.append(int((spans[:, 1] - spans[:, 0]).sum()))
                    spans_out.append(spans.astype("<i8").tobytes())
                    items_out.append(sorted(names))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), batch.column("text"), pa.array(n_words, pa.int64()),
                     pa.array(n_hit, pa.int64()), pa.array(spans_out, pa.binary()),
                     pa.array(items_out, pa.list_(pa.string()))],
                    names=["row", "text", "n_words", "n_hit", "spans", "items"])

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], rows.schema["text"], *_STATE]))


def find_passages(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  width: int = SHINGLE, chunk_bytes: int = CHUNK_BYTES,
                  keep: list[str] | None = None) -> DataFrame:
    """(row, n_words, n_hit, spans, items) of every document; row holds its columns, or `keep`.

    spans are the word ranges (first, end) as little-endian 64-bit pairs, items the ids with an
    occurring window, in string order. Null and empty texts have no words. Items without words
    match nothing; the passages of an item without id count as hits but are not listed. Repeated
    rows each get a result, an empty benchmark marks nothing, extra columns pass through in row.
    """
    if not 1 <= width <= 3:
        raise ValueError("shingles have one to three words")
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("string").alias("id"),
                             F.col(item_text).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-total // chunk_bytes))
    rows = docs.select(
        columns_in_one(docs, keep).alias("row"), F.col(text).cast("string").alias("text"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.lit(0).cast("bigint").alias("n_hit"), F.lit(bytearray()).alias("spans"),
        F.array().cast("array<string>").alias("items"))
    for chunk in range(chunks):
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(chunks)) == chunk)
        shingles = Shingles(sorted(map(tuple, part.collect()), key=str), window, width)
        counts = _count_shingles(docs, text, spark.sparkContext.broadcast(shingles))
        rows = _mark(rows, spark.sparkContext.broadcast(PrefixIndex(shingles, counts)))
        if chunk + 1 < chunks:
            rows = stored(rows, "decontaminate")
    return rows.drop("text")


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id",
                  **options) -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated) of every document."""
    found = find_passages(docs, benchmark, keep=[key], **options)
    return found.select(
        F.col("row").getField(key).alias(key), "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def without_passages(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no benchmark window occurs."""
    return find_passages(docs, benchmark, **options).where("n_hit = 0").select("row.*")
