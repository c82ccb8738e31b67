"""Document fingerprints from improbable features, in chained Bloom filters.

Every window of WINDOW bytes has an entropy. Text keeps close to a typical entropy; the further a
window's entropy is from it, the rarer the window ranks. Among each RUN neighbouring windows the
rarest is noted (the leftmost of equals), and windows noted often enough are the document's features.
Features are hashed into Bloom filters of 2048 bits, at most FILTER_FEATURES distinct ones to a
filter; a full filter is followed by the next. Two fingerprints are compared filter by filter: the
overlap of set bits, less what chance gives, as a share of the greatest possible.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 32
RUN = 32
#: How many of the RUN neighbourhoods must note a window.
NOTED = 8
#: Entropy (bits a byte) that windows of running text cluster around, and below which a window is
#: filler (repeated characters) and ranks last. Fixed values, so that fingerprints of different
#: tables compare.
TYPICAL_ENTROPY = 3.75
FILLER_ENTROPY = 1.5
FILTER_BITS = 2048
FILTER_HASHES = 5
FILTER_FEATURES = 160
SEED = 7
#: Rows that a range of keys holds about, and the most ranges.
RANGE_ROWS = 4_000
MAX_RANGES = 10_000
_SCALE = 1 << 20
_FIRST = -(1 << 63)


def _gains() -> np.ndarray:
    """Growth of c*log2(c) when a byte's count goes from c to c + 1, in fixed point."""
    counts = np.arange(WINDOW + 1, dtype=np.float64)
    weight = counts * np.log2(np.maximum(counts, 1))
    return np.rint(np.diff(weight) * _SCALE).astype(np.int64)


_GAINS = _gains()


def entropies(data: np.ndarray) -> np.ndarray:
    """Entropy of each window, in fixed point bits a byte times WINDOW.

    A byte that enters or leaves a window changes the sum only through how many equal bytes the
    other WINDOW - 1 places hold, so two running sums give all windows.
    """
    n = len(data)
    earlier, later = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for step in range(1, WINDOW):
        same = data[step:] == data[:-step]
        earlier[step:] += same
        later[:n - step] += same
    total = np.cumsum(_GAINS[earlier])
    total[WINDOW:] -= np.cumsum(_GAINS[later[:n - WINDOW]])
    return WINDOW * int(np.log2(WINDOW)) * _SCALE - total[WINDOW - 1:]


def ranks(entropy: np.ndarray) -> np.ndarray:
    """Smaller is rarer; filler comes last."""
    unit = WINDOW * _SCALE
    far = np.abs(entropy - int(TYPICAL_ENTROPY * unit)) >> 12
    rank = (8 * unit >> 12) - far
    rank[entropy < int(FILLER_ENTROPY * unit)] = 16 * unit >> 12
    return rank


def feature_positions(data: np.ndarray) -> np.ndarray:
    """First bytes of the windows that are features; at least one if there is a window."""
    count = len(data) - WINDOW + 1
    if count <= 0:
        return np.empty(0, np.int64)
    keyed = (ranks(entropies(data)) << 32) | np.arange(count)
    run, width = min(RUN, count), 1
    while width < run:
        step = min(width, run - width)
        keyed = np.minimum(keyed[:len(keyed) - step], keyed[step:])
        width += step
    noted = np.bincount(keyed & 0xFFFF_FFFF, minlength=count)
    chosen = np.flatnonzero(noted >= min(NOTED, run))
    return chosen if len(chosen) else np.array([int(noted.argmax())])


def features(raw: bytes) -> np.ndarray:
    """Hashes of the distinct features in order of appearance; a short text is one feature."""
    if not raw:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    if len(raw) < WINDOW:
        return np.array([digest(raw, SEED)], np.uint64)
    at = feature_positions(np.frombuffer(raw, np.uint8)).tolist()
    hashes = dict.fromkeys(digest(raw[i:i + WINDOW], SEED) for i in at)
    return np.fromiter(hashes, np.uint64, len(hashes))


def filters(raw: bytes) -> np.ndarray:
    """Chained Bloom filters, one row of bytes each; no row for an empty text."""
    hashes = features(raw)
    chain = -(-len(hashes) // FILTER_FEATURES)
    bits = np.zeros((chain, FILTER_BITS), bool)
    link = np.arange(len(hashes)) // FILTER_FEATURES
    for number in range(FILTER_HASHES):
        place = (hashes >> np.uint64(11 * number)) & np.uint64(FILTER_BITS - 1)
        bits[link, place.astype(np.int64)] = True
    return np.packbits(bits, axis=1)


def as_text(chain: np.ndarray) -> str:
    return chain.tobytes().hex()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), np.uint8).reshape(-1, FILTER_BITS // 8)


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    """0 to 1; both empty: 1, one empty: 0. The shorter chain looks for its best partners."""
    if not len(left) or not len(right):
        return float(len(left) == len(right))
    if len(left) > len(right):
        left, right = right, left
    a, b = left.view("<u8"), right.view("<u8")
    in_a = np.bitwise_count(a).sum(axis=1, dtype=np.int64)
    in_b = np.bitwise_count(b).sum(axis=1, dtype=np.int64)

    def best(one, of_one, many, of_many):
        total = 0.0
        for row, size in zip(one, of_one):
            shared = np.bitwise_count(many & row).sum(axis=1, dtype=np.int64)
            chance = of_many * (size / FILTER_BITS)
            most = np.minimum(of_many, size)
            score = (shared - chance) / np.maximum(most - chance, 1e-9)
            total += max(0.0, float(score.max()))
        return total / len(one)

    score = best(a, in_a, b, in_b)
    if len(a) == len(b):
        score = (score + best(b, in_b, a, in_a)) / 2
    return min(1.0, score)


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many from the start of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _ranges(keys: DataFrame, range_rows: int) -> list[int]:
    """Ascending first keys of key ranges with about range_rows rows each, at most MAX_RANGES."""
    wanted = min(MAX_RANGES, keys.count() // range_rows)
    if wanted < 1:
        return []
    cuts = keys.approxQuantile("k", [i / (wanted + 1) for i in range(1, wanted + 1)],
                               0.1 / (wanted + 1))
    return sorted({int(value) for value in cuts})


def in_order_with_next(docs: DataFrame, key: str, text: str,
                       range_rows: int = RANGE_ROWS) -> DataFrame:
    """(key, text, range, guest) placed so that each range is one sorted run of one partition.

    Ranges follow each other by descending key. A range's own rows (guest false) are followed by
    guests: the rows with the first key of the next range, or of the first range after the last.
    Only those travel twice. Keys of both bounds and ranges are settled on keys alone.
    """
    rows = docs.select(
        F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"),
        F.coalesce(F.col(key).cast("bigint"), F.lit(_FIRST)).alias("k"))
    cuts = np.array(_ranges(rows.select("k"), range_rows), np.int64)

    @F.pandas_udf("int")
    def range_of(k: pd.Series) -> pd.Series:
        return pd.Series(len(cuts) - np.searchsorted(cuts, k.to_numpy(), side="right"), dtype="i4")

    heads = {r["r"]: r["k"] for r in rows.select("k", range_of("k").alias("r")).groupBy("r").agg(
        F.max("k").alias("k")).collect()}
    used = sorted(heads)
    # The range that needs a range's first rows is the used one before it, cyclically.
    wanted_by = {heads[r]: used[i - 1] for i, r in enumerate(used)}
    head_keys = np.array(sorted(wanted_by), np.int64)
    head_targets = np.array([wanted_by[k] for k in head_keys.tolist()], np.int32)

    @F.pandas_udf("int")
    def guest_range(k: pd.Series) -> pd.Series:
        values = k.to_numpy()
        place = np.searchsorted(head_keys, values)
        place[place == len(head_keys)] = 0
        return pd.Series(np.where(head_keys[place] == values, head_targets[place], -1),
                         dtype="i4")

    placed = rows.withColumns({"own": range_of("k"), "guest_of": guest_range("k")})
    spots = F.explode(F.array(
        F.struct(F.col("own").alias("range"), F.lit(False).alias("guest")),
        F.struct(F.col("guest_of").alias("range"), F.lit(True).alias("guest")))).alias("spot")
    spread = placed.select("key", "k", "text", spots).where("spot.range >= 0").select(
        "key", "k", "text", "spot.range", "spot.guest")
    # Ranges are numbered from 0, so each becomes a partition of its own.
    return spread.repartitionById(max(used, default=0) + 1, F.col("range")).sortWithinPartitions(
        "range", "guest", F.col("k").desc(), F.col("text").asc_nulls_first()
    ).select("key", "text", "range", "guest")


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text",
                          range_rows: int = RANGE_ROWS) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how alike they are.

    Returns (key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).
    The next document is the one with the next smaller key; the last is followed by the first. Null
    keys come after all others, rows with equal keys follow each other by text. Null texts are
    empty. A single row is its own next. Extra columns are ignored, an empty table gives nothing.
    """
    names = [key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
             "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(),
             pa.float64()]

    def result(row, following) -> tuple:
        doc_id, value, chain = row
        changed = edited(value, following[1]).encode("utf-8", "surrogatepass")
        other = filters(changed)
        return (doc_id, len(value), hashlib.sha256(changed).hexdigest(), as_text(chain),
                as_text(other), likeness(chain, other), likeness(chain, following[2]))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, current, out, size = None, None, [], 0
        for batch in batches:
            for doc_id, value, place, guest in zip(*(batch.column(i) for i in range(4))):
                place, guest = place.as_py(), guest.as_py()
                if guest and (waiting is None or current != place):
                    continue  # only the first guest is the next document
                value = value.as_py() or ""
                row = doc_id.as_py(), value, filters(value.encode("utf-8", "surrogatepass"))
                if waiting is not None:
                    out.append(result(waiting, row))
                    size += len(value)
                    if size > 4_000_000 or len(out) >= 1_000:
                        yield batch_of(out)
                        out, size = [], 0
                waiting, current = (None, None) if guest else (row, place)
        if out:
            yield batch_of(out)

    ordered = in_order_with_next(docs, key, text, range_rows)
    return ordered.mapInArrow(
        run, f"`{key}` bigint, n_chars bigint, edited_sha256 string, fingerprint string,"
             " edited_fingerprint string, near_edited double, near_next double")
