"""Byte-pair encoding and decoding for the public word-end vocabulary.

Encoding keeps the symbols of a word in a doubly linked list and the possible merges in a priority
queue ordered by merge rank, then position; an entry whose symbols have changed since is stale and
skipped. Decoding concatenates vocabulary strings. The tokenizer file is read once on the driver and
reaches the tasks as a broadcast, so its path need not exist on the executors.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.llm.shared import columns_in_one

#: Strings in a generation of a cache; a worker process has one of two generations.
CACHE_ENTRIES = 400_000
CACHED_CHARS = 48
SLICE_ROWS = 500

# A stop or comma right after another mark (neither letter, digit nor white space).
_MARKS = re.compile(r"[.,](?:(?<=[^\w\s].)|(?<=_.))")

# White space as the tokenizer's own patterns mean it.
_SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_characters() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(byte if byte in shown else next(spare)) for byte in range(256)]


class Bounded(dict):
    """A cache of a function of a string, in two generations.

    When the younger is full it becomes the older and the older is forgotten; what is asked for
    again moves back into the younger, so frequent strings stay.
    """

    def __init__(self, function: Callable[[str], bytes], entries: int = CACHE_ENTRIES):
        super().__init__()
        self.function, self.entries, self.older = function, entries, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.function(key)
        if len(key) <= CACHED_CHARS:
            if len(self) >= self.entries:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class TextEncoder:
    """How a text falls into pieces, and the ids of all of them.

    `piece` encodes one piece. `whole`, if given, encodes a text as it stands; it is used where the
    lower-cased pieces would be normalized differently from the text they come from.
    """

    def __init__(self, spec: dict, piece: Callable[[str], bytes],
                 whole: Callable[[str], bytes] | None = None):
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        splits = [p["type"] for p in spec["pre_tokenizer"]["pretokenizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or splits != ["Split", "ByteLevel"]:
            raise ValueError("unknown kind of tokenizer file")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern.replace(r"\s", _SPACE))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile("|".join(map(re.escape, names)) or r"(?!)")
        self.piece, self.whole = piece, whole
        self.chunks = Bounded(self._chunk)

    def _chunk(self, chunk: str) -> bytes:
        """Ids of lower-cased text without plain white space."""
        if chunk.isalpha():
            return self.piece(chunk)
        pieces = self.pattern.findall(chunk)
        if len(pieces) == 1:
            return self.piece(pieces[0])
        return b"".join(map(self.chunks.__getitem__, pieces))

    def _plain(self, text: str) -> bytes:
        """Ids of a text without special tokens.

        The text is cut at plain white space, and stops and commas are cut off words where they
        follow no other mark. No piece and no Unicode composition spans such a cut.
        """
        raw = text
        if not text.isascii():
            # One character at a time: a final sigma is lower-cased like any other.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if self.whole and not text.isascii() and not unicodedata.is_normalized("NFC", text):
            return self.whole(raw)
        text = text.replace("\n", " ").replace("\t", " ").replace("\r", " ") + " "
        if not _MARKS.search(text):
            text = text.replace(". ", " . ").replace(", ", " , ")
        return b"".join(map(self.chunks.__getitem__, text.split(" ")))

    def encode(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids; special tokens are found before anything else."""
        if not text:
            return b""
        if "<" not in text:
            return self._plain(text)
        out, at = [], 0
        for match in self.special_pattern.finditer(text):
            out.append(self._plain(text[at:match.start()]))
            out.append(self.special[match[0]].to_bytes(4, "little"))
            at = match.end()
        out.append(self._plain(text[at:]))
        return b"".join(out)


class WordBpe:
    """Encoder and decoder of one tokenizer file (its JSON text)."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        if model["type"] != "BPE" or spec["decoder"] is not None or model["byte_fallback"]:
            raise ValueError("unknown kind of tokenizer file")
        self.texts = TextEncoder(spec, self.encode_piece)
        vocabulary: dict[str, int] = model["vocab"]
        self.strings = [""] * (max([*vocabulary.values(), *self.texts.special.values()]) + 1)
        for string, number in {**vocabulary, **self.texts.special}.items():
            self.strings[number] = string
        end = model["end_of_word_suffix"]
        characters = byte_characters()
        self.inner = [vocabulary[c] for c in characters]
        self.last = [vocabulary[c + end] for c in characters]
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocabulary[left], vocabulary[right]] = rank, vocabulary[left + right]

    def encode_piece(self, piece: str) -> bytes:
        """Ids of one piece, as little-endian 32-bit numbers."""
        raw = piece.encode("utf-8")
        symbols = [self.inner[byte] for byte in raw]
        symbols[-1] = self.last[raw[-1]]
        size, merges = len(symbols), self.merges
        before, after = list(range(-1, size - 1)), [*range(1, size), -1]
        queue = []
        for at in range(size - 1):
            merge = merges.get((symbols[at], symbols[at + 1]))
            if merge:
                queue.append((merge[0], at, merge[1], symbols[at], symbols[at + 1]))
        heapq.heapify(queue)
        while queue:
            _, at, merged, left, right = heapq.heappop(queue)
            other = after[at]
            if other < 0 or symbols[at] != left or symbols[other] != right:
                continue
            symbols[at], symbols[other] = merged, -1
            after[at] = after[other]
            if after[at] >= 0:
                before[after[at]] = at
            for first, second in ((before[at], at), (at, after[at])):
                if first >= 0 and second >= 0:
                    merge = merges.get((symbols[first], symbols[second]))
                    if merge:
                        heapq.heappush(queue, (merge[0], first, merge[1],
                                               symbols[first], symbols[second]))
        return np.array([s for s in symbols if s >= 0], "<i4").tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; null is empty."""
        return np.frombuffer(self.texts.encode(text), "<i4")

    def decode(self, ids) -> str:
        """Vocabulary strings joined by a space, special tokens included."""
        strings = self.strings
        return " ".join([strings[i] for i in ids])


@functools.lru_cache(maxsize=1)
def loaded(text: str) -> WordBpe:
    return WordBpe(text)


def read_tokenizer(path: str) -> str:
    """The tokenizer file's text, read on the driver."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode_and_decode(docs: DataFrame, tokenizer_path: str, text: str = "text",
                      keep: list[str] | None = None) -> DataFrame:
    """(row, ids, decoded) of every document; row holds its columns (or `keep`), ids its token ids.

    Null and empty texts have no ids and decode to an empty text. Repeated rows each get a result,
    an empty table gives an empty result.
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(spec.value)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                ids = [bpe.encode(value) for value in batch.column(1).to_pylist()]
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(i) for i in ids], out=offsets[1:])
                decoded = [bpe.decode(i.tolist()) for i in ids]
                flat = np.concatenate(ids).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                     pa.array(decoded, pa.string())], names=["row", "ids", "decoded"])

    rows = docs.select(columns_in_one(docs, keep).alias("row"),
                       F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, T.StructType([
        rows.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.StringType())]))


def token_digests(docs: DataFrame, tokenizer_path: str, key: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every document."""
    coded = encode_and_decode(docs, tokenizer_path, text, keep=[key])
    return coded.select(
        F.col("row").getField(key).alias(key),
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256)
        .alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
