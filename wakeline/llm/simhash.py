"""SimHash near-duplicates over a Gray-ordered hierarchical index.

Fingerprints are 64 majority bits over the XXH64 values of a text's word shingles. Two fingerprints
link when they differ in at most `max_bits` bits. The search routes each distinct fingerprint by
blocks of bits (among max_bits + 1 blocks, one is equal in any linked pair). Inside a route the
fingerprints are sorted by Gray rank; windows of neighbours form leaves, windows of leaves form upper
nodes. A node holds the bits all its members share; bits already held by its parent are not repeated.
A query walks down adding up the differences in the shared bits, and drops a whole group as soon as
the sum exceeds `max_bits`. Routes with too many members are cut again by their other bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.graph import components
from wakeline.llm.shared import bytes_or_empty, columns_in_one, cut

WORDS_PER_SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Fingerprints of one route that one task searches; larger routes are cut by further bits.
ROUTE_ROWS = 8_192
FANOUT = 8
#: Query-node pairs held at a time.
FRONTIER = 400_000


def shingles(text: str | None, words: int = WORDS_PER_SHINGLE) -> list[bytes]:
    """Space-joined word shingles, repeats included; a shorter text is one shingle of all words.

    Only A-Z are lower-cased, words end at ASCII white space; both are what bytes methods do.
    """
    tokens = bytes_or_empty(text).lower().split()
    if len(tokens) <= words:
        return [b" ".join(tokens)] if tokens else []
    line = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    starts = np.zeros(len(tokens), np.int64)
    np.cumsum(lengths[:-1] + 1, out=starts[1:])
    ends = starts + lengths
    return [line[a:b] for a, b in zip(starts[: 1 - words or None].tolist(),
                                      ends[words - 1:].tolist())]


def fingerprint(text: str | None, words: int = WORDS_PER_SHINGLE) -> int:
    """64 bits, each set when it is set in over half of the shingles' hashes; no words: zero."""
    parts = shingles(text, words)
    if not parts:
        return 0
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for start in range(0, len(parts), 65_536):
        piece = parts[start:start + 65_536]
        hashes = np.fromiter((digest(part, SEED) for part in piece), np.uint64, len(piece))
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    majority = (2 * total > len(parts)).astype(np.uint8)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 words: int = WORDS_PER_SHINGLE) -> DataFrame:
    """(key, text_hash, fp) of every row; fp is the unsigned fingerprint's bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(value, words) for value in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array(np.array(values, np.uint64).view(np.int64))],
                names=[key, "text_hash", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text_hash(text), text).mapInArrow(
        run, f"`{key}` {kind}, text_hash bigint, fp bigint")


def text_hash(text: str):
    """Tells the texts of a repeated key apart; null and empty differ."""
    return F.xxhash64(F.col(text).isNull(), text).alias("text_hash")


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Position of each 64-bit pattern in the reflected Gray sequence."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _levels(group: np.ndarray, values: np.ndarray) -> list[dict]:
    """Index levels over rows sorted by (group, Gray rank), leaves first.

    Nodes never span two groups. Each level has, by node: first and last child, first and last
    row, the mask of shared bits its parent does not hold, and their values. The top level has one
    node per group.
    """
    full = np.uint64(0xFFFF_FFFF_FFFF_FFFF)
    n = len(values)
    rows = np.arange(n)
    below = {"group": group, "ones": values, "zeros": ~values, "first": rows, "last": rows + 1}
    levels = []
    while True:
        size = len(below["group"])
        new = np.empty(size, bool)
        new[:1] = True
        new[1:] = below["group"][1:] != below["group"][:-1]
        start_of_group = np.maximum.accumulate(np.where(new, np.arange(size), 0))
        heads = np.flatnonzero((np.arange(size) - start_of_group) % FANOUT == 0)
        tails = np.append(heads[1:], size)
        node = {
            "group": below["group"][heads],
            "ones": np.bitwise_and.reduceat(below["ones"], heads),
            "zeros": np.bitwise_and.reduceat(below["zeros"], heads),
            "first": below["first"][heads], "last": below["last"][tails - 1],
            "child": heads, "end": tails,
        }
        node["mask"] = node["ones"] | node["zeros"]
        levels.append(node)
        if len(node["group"]) == int(new.sum()):
            break
        below = node
    for depth, node in enumerate(levels):
        if depth + 1 < len(levels):
            above = levels[depth + 1]
            parent = np.repeat(np.arange(len(above["child"])), above["end"] - above["child"])
            node["own"] = node["mask"] & ~above["mask"][parent]
        else:
            node["own"] = node["mask"] & full
    return levels


def _spread(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions first..end-1 of each range, with the number of the range they belong to."""
    sizes = end - first
    owner = np.repeat(np.arange(len(first)), sizes)
    offset = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return owner, first[owner] + offset


def search(group: np.ndarray, values: np.ndarray,
           max_bits: int = MAX_BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs (i < j) of one group that differ in at most max_bits bits, block by block.

    Rows must be sorted by (group, Gray rank). Memory is bounded by FRONTIER, not by the pairs.
    """
    if len(values) < 2:
        return
    levels = _levels(group, values)
    top = levels[-1]
    root_of_row = np.repeat(np.arange(len(top["group"])), top["last"] - top["first"])

    def descend(depth: int, query: np.ndarray, node: np.ndarray, spent: np.ndarray):
        if len(query) > FRONTIER:
            for start in range(0, len(query), FRONTIER):
                part = slice(start, start + FRONTIER)
                yield from descend(depth, query[part], node[part], spent[part])
            return
        level = levels[depth]
        # Only rows after the query itself are wanted.
        alive = level["last"][node] > query + 1
        query, node, spent = query[alive], node[alive], spent[alive]
        differs = (values[query] ^ level["ones"][node]) & level["own"][node]
        spent = spent + np.bitwise_count(differs)
        alive = spent <= max_bits
        query, node, spent = query[alive], node[alive], spent[alive]
        if not len(query):
            return
        owner, child = _spread(level["child"][node], level["end"][node])
        if depth > 0:
            yield from descend(depth - 1, query[owner], child, spent[owner])
            return
        left = query[owner]
        keep = child > left
        left, child = left[keep], child[keep]
        near = np.bitwise_count(values[left] ^ values[child]) <= max_bits
        if near.any():
            yield left[near], child[near]

    for start in range(0, len(values), FRONTIER):
        query = np.arange(start, min(start + FRONTIER, len(values)))
        yield from descend(len(levels) - 1, query, root_of_row[query],
                           np.zeros(len(query), np.uint8))


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """(row, root) links that connect what the pairs connect; fewer than n of them.

    Roots are the smallest row of their tree; whole blocks of pairs are hooked and shortened at a
    time.
    """
    root = np.arange(n)
    for left, right in pairs:
        while len(left):
            a, b = root[left], root[right]
            open_ = a != b
            if not open_.any():
                break
            left, right, a, b = left[open_], right[open_], a[open_], b[open_]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                shorter = root[root]
                if np.array_equal(shorter, root):
                    break
                root = shorter
    rows = np.flatnonzero(root != np.arange(n))
    return list(zip(rows.tolist(), root[rows].tolist()))


def _blocks(free: int, count: int) -> list[int]:
    """Masks that cut the set bits of `free` into `count` parts of nearly equal size."""
    bits = [bit for bit in range(64) if free >> bit & 1]
    count = min(count, len(bits))
    edges = [len(bits) * part // count for part in range(count + 1)]
    return [sum(1 << bit for bit in bits[a:b]) for a, b in zip(edges, edges[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _route(rows: DataFrame, max_bits: int) -> DataFrame:
    """One row per (fingerprint, route); `held` has the bits a route's members already share.

    rows: (fp, held). The number of distinct `held` masks depends on the depth only.
    """
    parts = []
    for (held,) in rows.select("held").distinct().collect():
        free = ~held & 0xFFFF_FFFF_FFFF_FFFF
        masks = [_signed(held & 0xFFFF_FFFF_FFFF_FFFF | block)
                 for block in _blocks(free, max_bits + 1)]
        parts.append((held, masks))
    if not parts:
        return rows.select("fp", "held", F.lit(0).cast("bigint").alias("route")).where("false")
    masks_of = F.lit(None)
    for held, masks in parts:
        masks_of = F.when(F.col("held") == F.lit(held), F.array(*(F.lit(mask).cast("bigint") for mask in masks))).otherwise(
            masks_of)
    routed = rows.select("fp", F.explode(masks_of).alias("held"))
    return routed.select(
        "fp", "held",
        F.xxhash64("held", F.col("fp").bitwiseAND(F.col("held"))).alias("route"))


def _searched(routed: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) between fingerprints of a route; enough to connect all linked ones."""
    tasks = routed.repartition("route").sortWithinPartitions("route")

    def links(route: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((gray_rank(values), route))
        route, values = route[order], values[order]
        same = route[1:] == route[:-1]
        paired = np.zeros(len(route), bool)
        paired[1:] |= same
        paired[:-1] |= same
        route, values = route[paired], values[paired]
        found = forest(len(values), search(route, values, max_bits))
        ends = np.array(found, np.int64).reshape(-1, 2)
        signed = values.view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(signed[ends[:, 0]]), pa.array(signed[ends[:, 1]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        route, values = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            if batch.num_rows:
                route = np.concatenate([route, batch.column(0).to_numpy()])
                values = np.concatenate([values, batch.column(1).to_numpy().view(np.uint64)])
                if len(route) >= 4 * ROUTE_ROWS:
                    # The last route may go on in the next batch.
                    whole = int(np.searchsorted(route, route[-1]))
                    if whole:
                        yield links(route[:whole], values[:whole])
                        route, values = route[whole:], values[whole:]
        if len(route):
            yield links(route, values)

    return tasks.select("route", "fp").mapInArrow(run, "a bigint, b bigint")


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS,
               route_rows: int = ROUTE_ROWS) -> DataFrame:
    """Links between the distinct fingerprints of column fp that connect all linked ones.

    A route with over route_rows members is searched after cutting its remaining bits again, as
    often as needed: its members differ only in bits it does not hold, so the cut loses nothing.
    """
    pending = distinct.select("fp", F.lit(0).cast("bigint").alias("held"))
    links = None
    while True:
        routed = cut(_route(pending, max_bits))
        crowded = cut(routed.groupBy("route").count().where(F.col("count") > route_rows)
                      .select("route"))
        if crowded.isEmpty():
            found = _searched(routed, max_bits)
            return found if links is None else links.union(found)
        found = cut(_searched(routed.join(crowded, "route", "left_anti"), max_bits))
        links = found if links is None else links.union(found)
        pending = routed.join(crowded, "route", "left_semi").select("fp", "held").distinct()


def component_names(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(fp, component_id) of every class (fp, least): the least that links between classes reach."""
    linked = cut(components(links))
    named = linked.join(classes, linked["node"] == classes["fp"]).select(
        "node", "component", "least")
    component_key = named.groupBy("component").agg(F.min("least").alias("linked_least"))
    of_linked = named.join(component_key, "component").select(
        F.col("node").alias("fp"), "linked_least")
    # Written down, so that the last join stands alone and a common fingerprint can be split.
    return cut(classes.join(of_linked, "fp", "left").select(
        "fp", F.coalesce("linked_least", "least").alias("component_id")))


def _grouped(docs: DataFrame, key: str, text: str, words: int, max_bits: int,
             route_rows: int) -> DataFrame:
    """(key, text_hash, fp, component_id) of every row."""
    marked = cut(fingerprints(docs, key, text, words))
    classes = cut(marked.groupBy("fp").agg(F.min(key).alias("least")))
    links = near_links(classes.select("fp"), max_bits, route_rows)
    return marked.join(component_names(classes, links), "fp")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    words: int = WORDS_PER_SHINGLE, max_bits: int = MAX_BITS,
                    route_rows: int = ROUTE_ROWS) -> DataFrame:
    """(key, fingerprint, component_id) of every row.

    component_id is the smallest key reachable over links, the row's own included. Null and empty
    texts have no words: fingerprint zero, linked like any other. Rows with a null key are members
    but never name a component that has another key. Repeated rows stay; extra columns are
    ignored; an empty table gives an empty result.
    """
    return _grouped(docs, key, text, words, max_bits, route_rows).select(
        key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text",
                words: int = WORDS_PER_SHINGLE, max_bits: int = MAX_BITS,
                route_rows: int = ROUTE_ROWS) -> DataFrame:
    """One row of each component, the one whose key names it, with all its columns.

    Rows with a null key go when their component has a key, else they stay. Of rows with equal key
    and text one stays, the least by its other columns.
    """
    return least_of_each(docs, _grouped(docs, key, text, words, max_bits, route_rows), key, text)


def least_of_each(docs: DataFrame, groups: DataFrame, key: str, text: str) -> DataFrame:
    """What one_of_each gives, for groups of rows (key, text_hash, component_id)."""
    other = F.col("component_id").isNotNull() & ~F.col(key).eqNullSafe(F.col("component_id"))
    marks = cut(groups.groupBy(F.col(key).alias("key"), F.col("text_hash").alias("hash")).agg(
        F.bool_or(other).alias("gone"), F.count(F.lit(1)).alias("n")).where("gone or n > 1"))
    rows = docs.select(columns_in_one(docs).alias("row"), F.col(key).alias("row_key"),
                       text_hash(text))
    kept = rows.join(
        marks, F.col("row_key").eqNullSafe(F.col("key")) & (F.col("text_hash") == F.col("hash")),
        "left").where("not coalesce(gone, false)")
    if marks.where("not gone").isEmpty():
        return kept.select("row.*")
    least = kept.where("n > 1").groupBy("row_key", "text_hash").agg(F.min("row").alias("row"))
    return kept.where("n is null").select("row.*").union(least.select("row.*"))
