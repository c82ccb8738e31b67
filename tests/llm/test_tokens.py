import hashlib
import io
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wakeline.llm.bpe import TextEncoder, WordBpe, encode_and_decode, read_tokenizer, token_digests
from wakeline.llm.packed_ids import (LibraryEncoder, Reader, Writer, bits_for, pack, packed_documents, read_packed,
                                     unpack, write_packed)

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " \n\t ", "Hello, world's 3rd 'll we'RE", "a" * 3000, "ǅ ΑΣ Σ İi ß ﬀ ﬁ",
    "café é́ ẛ̣ Å", "x y z　w\u0085v\x1cu\x0bt",
    "<|endoftext|>Hi<|startoftext|><|endoftext|> <|endoftext", "日本語テスト 中文 한국어 😀👍🏽 ñ",
    "!!'s ''t$$$ 12½²③ ٣", "Is ndble; whst!! the&&&by*** for%%%and###", "\u0000\u0001 ﻿​",
    "word " * 40_000, "<<<>>>", "́start", "a\r\nb\rc",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def bpe():
    return WordBpe(read_tokenizer(PATH))


@pytest.mark.parametrize("text", TEXTS)
def test_encodes_and_decodes_like_the_library(bpe, library, text):
    want = library.encode(text or "", add_special_tokens=False).ids
    ids = bpe.encode(text).tolist()
    assert ids == want
    assert bpe.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_random_texts(bpe, library):
    rng = random.Random(5)
    alphabet = "abcdeé ÀÑ.,'st\n12\t𝒳ßğ-́<|>endoftextJ̌_"
    cached = LibraryEncoder(read_tokenizer(PATH))
    for _ in range(800):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        want = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode(text).tolist() == want
        assert cached.encode(text, 2).tolist() == [*want, 2]


def test_small_cache_changes_nothing(bpe, library):
    small = TextEncoder(json.loads(read_tokenizer(PATH)), bpe.encode_piece)
    small.chunks.entries = 3
    for text in TEXTS[:-4]:
        want = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(small.encode(text), "<i4").tolist() == want
        assert len(small.chunks) <= 3 and len(small.chunks.older) <= 3


def test_digests_by_row(documents, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, "x y")]
    docs = documents(*rows).withColumns({"ids": F.lit(1), "row": F.lit("r"), "decoded": F.lit(2)})
    out = token_digests(docs, PATH)
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        plain = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(plain.encode()).hexdigest()))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert encode_and_decode(docs, PATH).where("row.doc_id = 3").count() == 2
    assert token_digests(docs.where("false"), PATH).count() == 0


@pytest.mark.parametrize("bits", [1, 5, 8, 11, 16, 17, 32])
def test_packing_round_trip(bits):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 1 << bits, 1001).astype(np.uint32)
    data = pack(ids, bits)
    assert len(data) == -(-1001 * bits // 8)
    assert unpack(data, 1001, bits).tolist() == ids.tolist()


def test_bits():
    assert [bits_for(n) for n in (1, 2, 3, 256, 257, 49_408)] == [1, 1, 2, 8, 9, 16]


@pytest.mark.parametrize("bits", [11, 16])
def test_file_gives_random_access(bits):
    class Kept(io.BytesIO):
        def close(self):
            self.data = self.getvalue()

    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 1 << bits, n).astype(np.uint32) for n in (0, 5, 900, 1, 63, 64, 65)]
    sink = Kept()
    writer = Writer(sink, bits, block_ids=64)
    for key, ids in zip([None, -4, 2, 2, 3, 4, 5], texts):
        writer.add(key, ids)
    writer.close()
    reader = Reader(io.BytesIO(sink.data))
    for number in (6, 2, 0, 5, 1, 3, 4):
        assert reader.document(number).tolist() == texts[number].tolist()
    assert reader.present.tolist() == [0, 1, 1, 1, 1, 1, 1]
    with pytest.raises(ValueError):
        Reader(io.BytesIO(sink.data[:-3]))
    with pytest.raises(ValueError):
        writer.add(9, np.array([1 << bits], np.uint64))


def test_packed_documents(spark, documents, library, tmp_path):
    rows = [(i * 7 % 100, f"{TEXTS[i % 12]} {i}") for i in range(100)]
    rows += [(None, "nothing"), (None, None), (5, None), (5, None)]
    docs = documents(*rows).withColumn("part", F.lit("p")).repartition(5)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1]))
    start, want = 0, []
    for i, t in ordered:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    out = packed_documents(docs, PATH, block_ids=256, file_ids=1000)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    files = write_packed(docs, PATH, f"file://{tmp_path}/ids", file_ids=1000)
    assert files.count() >= 5
    assert files.agg(F.sum("n_docs")).first()[0] == len(rows)
    assert not list((tmp_path / "ids").glob("*.tmp"))
    assert read_packed(files).count() == len(rows)
    assert packed_documents(docs.where("false"), PATH).count() == 0
