"""Token ids in fixed-width packed files.

Each id takes the fewest bits that hold the vocabulary, least significant bit first. Ids of
documents in ascending key order follow each other in blocks of BLOCK_IDS; the footer has the byte
offset of every block and, by document, its key and its first id, so that any document can be read
by itself and a whole block unpacks in a few numpy operations.

File: magic, packed blocks, footer, trailer. Footer (little endian): block offsets (uint64, one
more than blocks), document starts (uint64, one more than documents), keys (int64), key present
(uint8). Trailer: footer offset, ids, documents (uint64), bits, ids a block (uint32), magic.
"""

from __future__ import annotations

import functools
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wakeline.llm.bpe import TextEncoder, byte_characters, read_tokenizer
from wakeline.llm.shared import cut, new_folder, open_folder, publish

MAGIC = b"PKIDS01\n"
BLOCK_IDS = 1 << 16
#: A file is closed with the document that reaches this many ids.
FILE_IDS = 1 << 24
END_ID = 2
_TRAILER = struct.Struct("<QQQII8s")


def bits_for(vocabulary: int) -> int:
    """Bits that hold ids 0..vocabulary-1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1,
                         bitorder="little")
    return np.packbits(each[:, :bits], bitorder="little").tobytes()


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype("<u4")
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little")
    each = np.zeros((count, 32), np.uint8)
    each[:, :bits] = flat.reshape(count, bits)
    return np.packbits(each, axis=1, bitorder="little").view("<u4").reshape(-1)


class Writer:
    """Writes one file; holds one block and the footer's numbers."""

    def __init__(self, sink, bits: int, block_ids: int = BLOCK_IDS):
        self.sink, self.bits, self.block_ids = sink, bits, block_ids
        self.sink.write(MAGIC)
        self.offsets, self.starts = [len(MAGIC)], [0]
        self.keys, self.present = [], []
        self.waiting, self.held = [], 0

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.sink.write(data)
        self.offsets.append(self.offsets[-1] + len(data))

    def add(self, key: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >> self.bits:
            raise ValueError("id outside the vocabulary")
        self.keys.append(0 if key is None else key)
        self.present.append(key is not None)
        self.starts.append(self.starts[-1] + len(ids))
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.block_ids:
            flat = np.concatenate(self.waiting)
            whole = len(flat) // self.block_ids * self.block_ids
            for at in range(0, whole, self.block_ids):
                self._block(flat[at:at + self.block_ids])
            self.waiting, self.held = [flat[whole:]], len(flat) - whole

    def close(self) -> None:
        if self.held:
            self._block(np.concatenate(self.waiting))
        for values, kind in ((self.offsets, "<u8"), (self.starts, "<u8"), (self.keys, "<i8"),
                             (self.present, "u1")):
            self.sink.write(np.array(values, kind).tobytes())
        self.sink.write(_TRAILER.pack(self.offsets[-1], self.starts[-1], len(self.keys),
                                      self.bits, self.block_ids, MAGIC))
        self.sink.close()


class Reader:
    """Random access to one file (a seekable binary file object)."""

    def __init__(self, source):
        self.source = source
        source.seek(0, 2)
        size = source.tell()
        if size < len(MAGIC) + _TRAILER.size:
            raise ValueError("packed file is too short")
        source.seek(size - _TRAILER.size)
        footer, self.n_ids, n_docs, self.bits, self.block_ids, magic = _TRAILER.unpack(
            source.read(_TRAILER.size))
        source.seek(0)
        if magic != MAGIC or source.read(len(MAGIC)) != MAGIC:
            raise ValueError("not a packed id file")
        blocks = -(-self.n_ids // self.block_ids)
        source.seek(footer)
        data = source.read(size - _TRAILER.size - footer)
        if len(data) != 8 * (blocks + 1) + 8 * (n_docs + 1) + 9 * n_docs:
            raise ValueError("packed file has a broken footer")
        at = 8 * (blocks + 1)
        self.offsets = np.frombuffer(data, "<u8", blocks + 1)
        self.starts = np.frombuffer(data, "<u8", n_docs + 1, at).astype(np.int64)
        at += 8 * (n_docs + 1)
        self.keys = np.frombuffer(data, "<i8", n_docs, at)
        self.present = np.frombuffer(data, "u1", n_docs, at + 8 * n_docs)
        self.recent: tuple[int, np.ndarray] | None = None

    def block(self, number: int) -> np.ndarray:
        if self.recent is None or self.recent[0] != number:
            first, end = int(self.offsets[number]), int(self.offsets[number + 1])
            self.source.seek(first)
            count = min(self.block_ids, self.n_ids - number * self.block_ids)
            self.recent = number, unpack(self.source.read(end - first), count, self.bits)
        return self.recent[1]

    def ranges(self, first: int, end: int) -> Iterator[np.ndarray]:
        """Ids first..end-1 of the file, a block's share at a time."""
        while first < end:
            number, inside = divmod(first, self.block_ids)
            part = self.block(number)[inside:inside + end - first]
            yield part
            first += len(part)

    def document(self, number: int) -> np.ndarray:
        parts = list(self.ranges(int(self.starts[number]), int(self.starts[number + 1])))
        return np.concatenate(parts) if parts else np.empty(0, "<u4")


class LibraryEncoder:
    """Ids from the tokenizers library; each distinct piece of text is encoded once.

    The library's model encodes a piece, shown as the byte characters its vocabulary is made of.
    """

    def __init__(self, text: str):
        self.tokenizer = Tokenizer.from_str(text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.texts = TextEncoder(json.loads(text), self._piece, self._whole)
        self.shown = dict(enumerate(byte_characters()))

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1")
        shown = piece.translate(self.shown)
        return np.array([token.id for token in self.model.tokenize(shown)], "<u4").tobytes()

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str | None, end_id: int) -> np.ndarray:
        return np.frombuffer(self.texts.encode(text) + end_id.to_bytes(4, "little"), "<u4")


@functools.lru_cache(maxsize=1)
def loaded(text: str) -> LibraryEncoder:
    return LibraryEncoder(text)


def write_packed(docs: DataFrame, tokenizer_path: str, folder: str, key: str = "doc_id",
                 text: str = "text", end_id: int = END_ID, block_ids: int = BLOCK_IDS,
                 file_ids: int = FILE_IDS) -> DataFrame:
    """Write every document's ids and the end id in ascending key order; returns the file list.

    File list: (part, number, path, n_ids, n_docs), in that order the order of documents. Null keys
    come first; equal keys are ordered by text. A repeated task writes the same names again.
    """
    spec_text = read_tokenizer(tokenizer_path)
    vocabulary = Tokenizer.from_str(spec_text).get_vocab_size(with_added_tokens=True)
    bits = bits_for(vocabulary)
    spec = docs.sparkSession.sparkContext.broadcast(spec_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(spec.value)
        fs, base = open_folder(folder)
        fs.create_dir(base, recursive=True)
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        writer, number, made = None, 0, []

        def finish():
            name = f"{base}/part-{part:06d}-{number:05d}.ids"
            writer.close()
            publish(fs, f"{name}.{attempt}.tmp", name)
            made.append((part, number, f"{folder}/part-{part:06d}-{number:05d}.ids",
                         writer.starts[-1], len(writer.keys)))

        for batch in batches:
            for doc_id, value in zip(batch.column(0), batch.column(1)):
                if writer is None:
                    name = f"{base}/part-{part:06d}-{number:05d}.ids"
                    sink = fs.open_output_stream(f"{name}.{attempt}.tmp", compression=None)
                    writer = Writer(sink, bits, block_ids)
                writer.add(doc_id.as_py(), encoder.encode(value.as_py(), end_id))
                if writer.starts[-1] >= file_ids:
                    finish()
                    writer, number = None, number + 1
        if writer is not None:
            finish()
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(
                zip(*made) if made else [[]] * 5,
                (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
            names=["part", "number", "path", "n_ids", "n_docs"])

    order = [F.col("key").asc_nulls_first(), F.col("text").asc_nulls_first()]
    rows = docs.select(F.col(key).cast("bigint").alias("key"),
                       F.col(text).cast("string").alias("text"))
    placed = rows.repartitionByRange(order[0]).sortWithinPartitions(*order)
    return cut(placed.mapInArrow(
        run, "part int, number int, path string, n_ids bigint, n_docs bigint"))


def read_packed(files: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document, from the files alone.

    start counts all ids before the document in all files. The order of files is settled over the
    file list, which has one row per FILE_IDS ids.
    """
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                fs, inside = open_folder(path)
                with fs.open_input_file(inside) as source:
                    reader = Reader(source)
                    starts = reader.starts
                    crcs = np.zeros(len(reader.keys), np.int64)
                    for number in range(len(crcs)):
                        crc = 0
                        for ids in reader.ranges(int(starts[number]), int(starts[number + 1])):
                            crc = zlib.crc32(np.ascontiguousarray(ids, "<u4"), crc)
                        crcs[number] = crc
                yield pa.RecordBatch.from_arrays(
                    [pa.array(reader.keys, mask=reader.present == 0),
                     pa.array(starts[:-1] + base), pa.array(np.diff(starts)), pa.array(crcs)],
                    names=[key, "start", "n_tokens", "ids_crc32"])

    # One file a task; the list is tiny, so its size must not decide the number of tasks.
    tasks = max(1, min(files.count(), 10_000))
    return placed.select("path", "base").repartition(tasks).mapInArrow(
        run, f"`{key}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def packed_documents(docs: DataFrame, tokenizer_path: str, key: str = "doc_id",
                     text: str = "text", **options) -> DataFrame:
    """Write the documents' ids below the shared folder and read them back.

    Null and empty texts have the end id only. Repeated rows are written as often as they occur;
    an empty table writes no file and gives an empty result; extra columns are ignored.
    """
    folder = new_folder(docs.sparkSession, "packed-ids")
    return read_packed(write_packed(docs, tokenizer_path, folder, key, text, **options), key)
