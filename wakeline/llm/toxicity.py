"""Toxicity by a small convolutional text classifier, trained in numpy.

A word's vector is the sum of hashed embedding rows, of its own row and of the rows of its letter
sequences, so that an unseen form of a known stem still says something. Filters of one to three words
run over the whole text, each keeps its highest response (max pooling), and a logistic layer adds the
responses up. The first embedding number starts as the shrunk log-odds of the row in the training
texts; while a text is trained on, its own fold is left out of that number. The other numbers start
at random from a fixed seed.

Thresholds are set by language on texts the weights were not trained on; a language of which those
hold one class alone gets its threshold from the texts that the weights were trained on. The language
is read from the text itself, by its function words. A score of 0.5 is the threshold of the text's
language, or that of all texts where no function word or no label tells more.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.llm.shared import columns_in_one, cut

BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
DIMENSIONS = 8
#: Sizes of the letter sequences of a word.
LETTERS = (4, 5, 6)
WIDTHS = (1, 2, 3)
FILTERS = 8
#: Labelled rows that one task trains on, about; the networks of all tasks are averaged.
SHARD_ROWS = 6_000
#: Rows of the rarer class that each of these tasks gets, about; scarcer ones go to several tasks.
CLASS_ROWS = 20
#: Logits are ranked within steps of this width, all steps side by side.
LOGIT_STEP = 2.0 ** -6
#: F1 that a threshold may lack to the highest.
F1_SLACK = 1e-3
#: Fixed-point unit of weights that travel, so that their sums hang on no order.
UNIT = 2.0 ** -44
EPOCHS = 4
TRAIN_FOLDS = 3
BATCH = 32
RATE = 0.05
EMBEDDING_RATE = 0.003
#: Texts that pull a row's log-odds half way from zero.
SHRINK = 5
SEED = 11
FOLDS = 5
SLICE_ROWS = 500
#: Words whose responses a task keeps.
LEXICON_WORDS = 200_000

# Fixed function words by language.
LANGUAGES = {
    "en": "the and of to in is that it for with was on are this from".split(),
    "de": "der die und den das von mit ist nicht ein zu im des dem auf".split(),
    "fr": "le la les des et que qui dans une pour pas sur un du au".split(),
    "es": "el los las que y una por con para del no se es en al".split(),
}
#: Stands for all texts where a place in LANGUAGES stands for those of one.
ALL_TEXTS = -2

_FACTOR, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
_KEPT = bytes(byte if byte >= 0x80 or chr(byte).isalnum() else 0x20 for byte in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words without case and punctuation."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_KEPT).split()


def rows_of_words(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of the words one after the other, and how many each word has.

    A word has its own row and one for each of its letter sequences (of UTF-8 bytes, with marks at
    both ends of the word). Sequences of all words are hashed at once by a polynomial in the bytes.
    """
    framed = b"".join(b"<" + word + b">" for word in words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(lengths)
    data = np.frombuffer(framed, np.uint8).astype(np.uint64) + np.uint64(1)
    left = np.repeat(ends, lengths) - np.arange(len(data))  # bytes to the word's end
    owner = np.repeat(np.arange(len(words)), lengths)
    rows = [np.fromiter((zlib.crc32(word) % BUCKETS for word in words), np.int32, len(words))]
    owners = [np.arange(len(words))]
    for size in LETTERS:
        at = np.flatnonzero(left >= size)
        mixed = np.full(len(at), size, np.uint64)
        for step in range(size):
            mixed = mixed * _FACTOR + data[at + step]
        mixed ^= mixed >> np.uint64(29)
        rows.append((mixed * _MIX >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
        owners.append(owner[at])
    order = np.argsort(np.concatenate(owners), kind="stable")
    sizes = 1 + sum(np.maximum(lengths - size + 1, 0) for size in LETTERS)
    return np.concatenate(rows)[order], sizes


def word_vectors(rows: np.ndarray, sizes: np.ndarray, embedding: np.ndarray) -> np.ndarray:
    """Sum of each word's rows over the root of their number; every word has a row."""
    out = np.zeros((len(sizes), embedding.shape[1]), np.float32)
    starts = np.cumsum(sizes) - sizes
    for at in range(0, len(sizes), 20_000):
        first, last = starts[at], starts[min(at + 20_000, len(sizes)) - 1]
        last += sizes[min(at + 20_000, len(sizes)) - 1]
        out[at:at + 20_000] = np.add.reduceat(embedding.take(rows[first:last], axis=0),
                                              starts[at:at + 20_000] - first, axis=0)
    return out / np.sqrt(sizes)[:, None].astype(np.float32)


_FUNCTION_WORDS: dict[bytes, int] = {}
for _place, _words in enumerate(LANGUAGES.values()):
    for _word in _words:
        _key = _word.encode()
        _FUNCTION_WORDS[_key] = _FUNCTION_WORDS.get(_key, 0) | 1 << _place


def language_counts(words: list[bytes]) -> list[int]:
    found = Counter(filter(None, map(_FUNCTION_WORDS.get, words)))
    return [sum(n for marks, n in found.items() if marks >> place & 1)
            for place in range(len(LANGUAGES))]


def language_of(words: list[bytes]) -> int:
    """Place of the likeliest language in LANGUAGES (the first of equals), or -1 without cues."""
    counts = language_counts(words)
    return counts.index(max(counts)) if max(counts) else -1


@dataclass
class Network:
    embedding: np.ndarray
    filters: list[np.ndarray]  # by width: (width, DIMENSIONS, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    thresholds: dict[int, float] = field(default_factory=dict)
    common: float = 0.0


class Scorer:
    """Scores texts; every word's responses to all filter places are worked out once and kept."""

    def __init__(self, net: Network, capacity: int = LEXICON_WORDS):
        self.net, self.capacity = net, capacity
        self.joined = np.concatenate([part[step] for part in net.filters
                                      for step in range(len(part))], axis=1).astype(np.float32)
        self._forget()

    def _forget(self) -> None:
        # Row 0 stands for no word.
        self.numbers: dict[bytes, int] = {}
        self.responses = np.zeros((self.capacity, self.joined.shape[1]), np.float32)

    def _learn(self, texts: list[list[bytes]]) -> None:
        """Number the words not met before; starts anew between calls when full."""
        if len(self.numbers) >= self.capacity:
            self._forget()
        new = list(set().union(*texts).difference(self.numbers))
        first, end = len(self.numbers) + 1, len(self.numbers) + 1 + len(new)
        if end > len(self.responses):
            more = np.zeros((end, self.responses.shape[1]), np.float32)
            more[:first] = self.responses[:first]
            self.responses = more
        for at in range(0, len(new), 20_000):
            rows, sizes = rows_of_words(new[at:at + 20_000])
            # Not a matrix product: a word's numbers must not depend on which others are new.
            self.responses[first + at:first + at + len(sizes)] = np.einsum(
                "wd,df->wf", word_vectors(rows, sizes, self.net.embedding), self.joined)
        self.numbers.update(zip(new, range(first, end)))

    def pooled(self, words: list[bytes]) -> np.ndarray:
        """Highest response of each filter over the whole text; windows may run past its end."""
        n = max(1, len(words))
        padded = np.zeros(n + WIDTHS[-1] - 1, np.int32)
        padded[:len(words)] = np.fromiter(map(self.numbers.__getitem__, words), np.int32,
                                          len(words))
        best = np.full((len(WIDTHS), FILTERS), -np.inf, np.float32)
        # A block of positions at a time bounds the memory a long text takes.
        for at in range(0, n, 8_192):
            end = min(n, at + 8_192)
            seen = self.responses[padded[at:end + WIDTHS[-1] - 1]]
            column = 0
            for place, width in enumerate(WIDTHS):
                total = seen[:end - at, column:column + FILTERS]
                for step in range(1, width):
                    column += FILTERS
                    total = total + seen[step:end - at + step, column:column + FILTERS]
                column += FILTERS
                np.maximum(best[place], total.max(axis=0), out=best[place])
        return np.maximum(best.ravel() + self.net.bias, 0)

    def logits(self, texts: list[list[bytes]]) -> list[float]:
        self._learn(texts)
        return [float(self.pooled(words) @ self.net.out + self.net.out_bias) for words in texts]

    def scores(self, texts: list[str | None]) -> list[float]:
        """0 to 1; 0.5 is the threshold of the text's language."""
        split = [words_of(text) for text in texts]
        limits = [self.net.thresholds.get(language_of(words), self.net.common)
                  for words in split]
        return [float(1 / (1 + np.exp(-np.clip(logit - limit, -60, 60))))
                for logit, limit in zip(self.logits(split), limits)]


def untrained() -> Network:
    """Scores every text alike, and low."""
    return Network(np.zeros((BUCKETS, DIMENSIONS), np.float32),
                   [np.zeros((w, DIMENSIONS, FILTERS)) for w in WIDTHS],
                   np.zeros(len(WIDTHS) * FILTERS), np.zeros(len(WIDTHS) * FILTERS), -10.0)


class _Sample:
    """The training texts as word numbers, and the embedding rows of each word (flat, by word)."""

    def __init__(self, texts: list[str | None]):
        numbers: dict[bytes, int] = {}
        self.texts = []
        for text in texts:
            words = words_of(text)
            self.texts.append(np.fromiter(
                (numbers.setdefault(w, len(numbers) + 1) for w in words), np.int32, len(words)))
        flat, sizes, known = [], [], list(numbers)
        for at in range(0, len(known), 20_000):
            rows, each = rows_of_words(known[at:at + 20_000])
            flat.append(rows)
            sizes.append(each)
        self.rows = np.concatenate([np.empty(0, np.int32), *flat])
        # Number 0 is no word and has no rows.
        self.sizes = np.concatenate([[0], *sizes]).astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def rows_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embedding rows of some words, and the place among them each row belongs to."""
        sizes = self.sizes[words]
        owner = np.repeat(np.arange(len(words)), sizes)
        offset = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.rows[self.starts[words][owner] + offset], owner

    def vectors(self, embedding: np.ndarray) -> np.ndarray:
        """Vector of every word; no word is zero."""
        out = np.zeros((len(self.sizes), embedding.shape[1]), np.float32)
        if len(self.rows):
            out[1:] = word_vectors(self.rows, self.sizes[1:], embedding)
        return out


def _row_counts(sample: _Sample, toxic: np.ndarray, folds: np.ndarray) -> np.ndarray:
    """Training texts by fold and class in which each embedding row occurs."""
    counts = np.zeros((int(folds.max()) + 1, 2, BUCKETS), np.float32)
    for words, label, fold in zip(sample.texts, toxic, folds):
        rows, _ = sample.rows_of(np.unique(words))
        counts[fold, label, rows] += 1  # once, however often a row stands there
    return counts


def subtract_at(table: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """np.subtract.at to the last bit, which is slow for values of a wider type than the table.

    The first occurrences of all rows are subtracted at once, then the second ones, and so on.
    """
    order = np.argsort(rows, kind="stable")
    first = np.flatnonzero(np.diff(rows[order], prepend=-1))
    nth = np.arange(len(rows)) - np.repeat(first, np.diff(first, append=len(rows)))
    order, at = order[np.argsort(nth, kind="stable")], 0
    rows, values = rows[order], values.take(order, axis=0)
    for n in np.bincount(nth).tolist():
        own = rows[at:at + n]
        table[own] = table.take(own, axis=0) - values[at:at + n]
        at += n


def _log_odds(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """By row, shrunk towards zero the fewer texts it occurs in."""
    share = np.log((counts + 0.5) / (sizes[:, None] + 1))
    seen = counts.sum(axis=0)
    return np.clip(share[1] - share[0], -4, 4) * seen / (seen + SHRINK)


class _Adam:
    def __init__(self, value: np.ndarray, rate: float):
        self.value, self.rate, self.step = value, rate, 0
        self.mean, self.square = np.zeros_like(value), np.zeros_like(value)

    def move(self, grad: np.ndarray) -> None:
        self.step += 1
        self.mean += 0.1 * (grad - self.mean)
        self.square += 0.001 * (grad * grad - self.square)
        mean = self.mean / (1 - 0.9 ** self.step)
        square = self.square / (1 - 0.999 ** self.step)
        self.value -= self.rate * mean / (np.sqrt(square) + 1e-8)


def _start(rng: np.random.Generator) -> Network:
    """The network every training begins with."""
    embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    embedding[:, 0] = 0
    filters = [rng.normal(0, 0.1, (w, DIMENSIONS, FILTERS)) for w in WIDTHS]
    for part in filters:
        part[:, 0, :2] = 1 / len(part)
    size = len(WIDTHS) * FILTERS
    net = Network(embedding, filters, np.zeros(size), rng.normal(0, 0.05, size), -1.0)
    net.out[::FILTERS] = 0.5
    return net


def train(texts: list[str | None], toxic: np.ndarray, epochs: int = EPOCHS) -> Network:
    """Fit the weights on all these texts in one place."""
    net, counts, sizes = descend(texts, toxic, epochs)
    net.embedding[:, 0] += _log_odds(counts, sizes)
    return net


def descend(texts: list[str | None], toxic: np.ndarray,
            epochs: int = EPOCHS) -> tuple[Network, np.ndarray, np.ndarray]:
    """Weights without the log-odds of the rows, and the counts these come from.

    Gradients flow through the pooled positions alone.
    """
    rng = np.random.default_rng(SEED)
    sample = _Sample(texts)
    folds = np.arange(len(texts)) % TRAIN_FOLDS
    sizes = np.array([[np.sum((folds == f) & (toxic == c)) for c in (0, 1)]
                      for f in range(TRAIN_FOLDS)], float)
    counts = _row_counts(sample, toxic, folds)
    all_counts, all_sizes = counts.sum(axis=0), sizes.sum(axis=0)
    odds = [_log_odds(all_counts - counts[f], all_sizes - sizes[f]) for f in range(len(counts))]
    odds += [_log_odds(all_counts, all_sizes)] * (TRAIN_FOLDS - len(counts))
    del counts
    net = _start(rng)
    movers = [_Adam(part, RATE / 10) for part in net.filters]
    bias, out = _Adam(net.bias, RATE / 10), _Adam(net.out, RATE)
    out_bias = _Adam(np.array([net.out_bias]), RATE)
    heat = np.full(BUCKETS, 1e-3)
    for _ in range(epochs):
        # Word vectors are renewed once for each fold of an epoch.
        for fold in rng.permutation(TRAIN_FOLDS):
            own = np.flatnonzero(folds == fold)
            start = net.embedding.copy()
            start[:, 0] += odds[fold]
            vectors_of = sample.vectors(start)
            order = rng.permutation(own)
            for at in range(0, len(order), BATCH):
                chosen = order[at:at + BATCH]
                padded, first, last, place = [], [], [], 0
                for number in chosen:
                    words = sample.texts[number]
                    words = words if len(words) else np.zeros(1, np.int32)
                    padded += [words, np.zeros(WIDTHS[-1] - 1, np.int32)]
                    first.append(place)
                    last.append(place + len(words))
                    place += len(words) + WIDTHS[-1] - 1
                words = np.concatenate(padded)
                vectors = vectors_of[words].astype(float)  # once, not in each product
                spots, pooled = [], []
                for part in net.filters:
                    reach = place - len(part) + 1
                    total = sum(vectors[step:reach + step] @ part[step]
                                for step in range(len(part)))
                    spot = np.stack([a + total[a:b].argmax(axis=0) for a, b in zip(first, last)])
                    spots.append(spot)
                    pooled.append(total[spot, np.arange(FILTERS)])
                raw = np.concatenate(pooled, axis=1) + net.bias
                high = np.maximum(raw, 0)
                logits = high @ net.out + out_bias.value[0]
                wrong = 1 / (1 + np.exp(-np.clip(logits, -60, 60))) - toxic[chosen]
                wrong /= len(chosen)
                back = wrong[:, None] * net.out * (raw > 0)
                for width, (part, spot, mover) in enumerate(zip(net.filters, spots, movers)):
                    share = back[:, width * FILTERS:(width + 1) * FILTERS]
                    grad = np.zeros_like(part)
                    for step in range(len(part)):
                        grad[step] = np.einsum("bf,bfd->df", share, vectors[spot + step])
                        pull = (share[:, :, None] * part[step].T[None]).reshape(-1, DIMENSIONS)
                        rows, owner = sample.rows_of(words[spot + step].ravel())
                        pulls = pull[owner]
                        np.add.at(heat, rows, (pulls ** 2).mean(axis=1))
                        subtract_at(net.embedding, rows,
                                    EMBEDDING_RATE * pulls / np.sqrt(heat[rows])[:, None])
                    mover.move(grad + 1e-4 * part)
                bias.move(back.sum(axis=0))
                out.move(high.T @ wrong + 1e-3 * net.out)
                out_bias.move(np.array([wrong.sum()]))
    net.out_bias = float(out_bias.value[0])
    return net, all_counts, all_sizes


def best_threshold(logits: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> float:
    """Middle of the thresholds with (nearly) the highest F1 over weighted texts."""
    order = np.argsort(-logits, kind="stable")
    sorted_logits, hit, mass = logits[order], toxic[order] * weight[order], weight[order]
    found, taken = np.cumsum(hit), np.cumsum(mass)
    f1 = 2 * found / (taken + hit.sum())
    # A threshold between equal logits cannot separate them.
    ends = np.append(sorted_logits[1:] < sorted_logits[:-1], True)
    f1 = np.where(ends, f1, -1)
    good = np.flatnonzero(f1 >= f1.max() - F1_SLACK)
    below = np.append(sorted_logits[1:], sorted_logits[-1] - 1)
    return float((sorted_logits[good[0]] + below[good[-1]]) / 2)


def fit_network(texts: list[str | None], toxic: np.ndarray, spare: np.ndarray,
                weight: np.ndarray) -> Network:
    """Weights from the texts that are not spare, thresholds from the spare ones.

    weight says for how many rows of the table a text stands.
    """
    known = np.flatnonzero(~spare)
    if len(set(toxic[known].tolist())) < 2:
        return untrained()
    net = train([texts[i] for i in known], toxic[known])
    scorer = Scorer(net)
    for judge in (known, np.flatnonzero(spare)):
        logits, languages = [], []
        for at in range(0, len(judge), SLICE_ROWS):
            split = [words_of(texts[i]) for i in judge[at:at + SLICE_ROWS]]
            logits += scorer.logits(split)
            languages += map(language_of, split)
        set_thresholds(net, np.array(logits), np.array(languages, int), toxic[judge],
                       weight[judge])
    return net


def set_thresholds(net: Network, logits: np.ndarray, languages: np.ndarray, toxic: np.ndarray,
                   weight: np.ndarray) -> None:
    """The threshold of all texts and of each language; those of which one class is here stay."""
    if len(set(toxic.tolist())) < 2:
        return
    net.common = best_threshold(logits, toxic, weight)
    for language in range(len(LANGUAGES)):
        own = languages == language
        if len(set(toxic[own].tolist())) == 2:
            net.thresholds[language] = best_threshold(logits[own], toxic[own], weight[own])


def fold_of(key):
    """CRC-32 of the key as text, modulo FOLDS; a null key counts as an empty text (fold 0)."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")),
                  F.lit(FOLDS))


def _labelled(docs: DataFrame, known: DataFrame, shards: int) -> DataFrame:
    """(key, toxic, text) of the keys that both tables hold, each key in one of `shards` partitions.

    A key may be repeated any number of times; the smallest of its texts stays.
    """
    both = docs.select("key", F.lit(None).cast("int").alias("toxic"), "text",
                       F.lit(True).alias("found")).union(
        known.select("key", "toxic", F.lit(None).cast("string"), F.lit(False)))
    return both.repartition(shards, "key").groupBy("key").agg(
        F.max("toxic").alias("toxic"), F.min("text").alias("text"),
        F.max("found").alias("found")).where("found and toxic is not null").drop("found")


_PARTS = [f"d{i}" for i in range(DIMENSIONS)]


def _flat(net: Network) -> np.ndarray:
    """All numbers but the embedding, in rows of DIMENSIONS."""
    flat = np.concatenate([*(part.ravel() for part in net.filters), net.bias, net.out,
                           [net.out_bias]])
    return np.append(flat, np.zeros(-len(flat) % DIMENSIONS)).reshape(-1, DIMENSIONS)


def _unflat(net: Network, rows: np.ndarray) -> None:
    flat, at = rows.ravel(), 0
    for part in (*net.filters, net.bias, net.out):
        part[...] = flat[at:at + part.size].reshape(part.shape)
        at += part.size
    net.out_bias = float(flat[at])


def _dealt(rows: DataFrame, shards: int, copies: tuple[int, int]) -> DataFrame:
    """(key, toxic, text) with each row in as many of the partitions as its class has copies."""
    if copies == (1, 1):
        return rows
    number = F.when(F.col("toxic") == 1, F.lit(copies[1])).otherwise(F.lit(copies[0]))
    first = F.pmod(F.hash("key"), F.lit(shards))
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(0), number - 1))).repartitionById(
        shards, F.pmod(first + F.col("copy"), F.lit(shards))).drop("copy")


def _trained(rows: DataFrame, copies: tuple[int, int] = (1, 1)) -> tuple[Network, list[int]]:
    """One network from those of all partitions of (key, toxic, text); untrained for one class.

    Also the languages of which there are texts of both classes. Each partition starts alike and
    trains on all its rows (a partition of one class has nothing to tell apart, see _dealt). A row of
    the embedding moves by the mean over the partitions it occurs in, the other numbers by the mean
    over all; the log-odds come from the counts of all rows, each counted once. What reaches the
    driver hangs on the size of the network alone.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(text or "", toxic) for batch in batches
                 for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        if not found:
            return
        found.sort()
        toxic = np.array([label for _, label in found], int)
        both = len(set(toxic.tolist())) == 2
        net, counts, sizes = descend([text for text, _ in found], toxic, EPOCHS if both else 0)
        start = _start(np.random.default_rng(SEED))
        used = np.flatnonzero(counts.any(axis=0))
        moved = np.concatenate([_flat(net) - _flat(start),
                                net.embedding[used].astype(float) - start.embedding[used]])
        moved = np.round(moved / UNIT).astype(np.int64)
        small = len(moved) - len(used)
        seen = np.zeros((2, len(moved)), np.int64)
        seen[:, small:] = counts[:, used]
        seen[:, 0] = sizes
        languages = np.zeros((2, len(LANGUAGES)), np.int64)
        for text, label in found:
            if (place := language_of(words_of(text))) >= 0:
                languages[label, place] += 1
        at = np.concatenate([-1 - np.arange(small), used, BUCKETS + np.arange(len(LANGUAGES))])
        moved = np.concatenate([moved, np.zeros((len(LANGUAGES), DIMENSIONS), np.int64)])
        seen = np.concatenate([seen, languages], axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(np.full(len(at), int(both))),
             pa.array(seen[0]), pa.array(seen[1]),
             *(pa.array(np.ascontiguousarray(moved[:, i])) for i in range(DIMENSIONS))],
            ["at", "n", "clean", "toxic", *_PARTS])

    fields = ", ".join(f"{name} bigint" for name in ("n", "clean", "toxic", *_PARTS))
    sums = rows.select("toxic", "text").mapInArrow(run, f"at int, {fields}").groupBy("at").agg(
        *(F.sum(name).alias(name) for name in ("n", "clean", "toxic", *_PARTS))).toArrow()
    at, n, clean, toxic = (sums[name].to_numpy() for name in ("at", "n", "clean", "toxic"))
    clean, toxic = clean // copies[0], toxic // copies[1]
    sizes = np.array([clean[at == -1].sum(), toxic[at == -1].sum()], float)
    if not sizes.all():
        return untrained(), []
    languages = sorted((at[(at >= BUCKETS) & (clean > 0) & (toxic > 0)] - BUCKETS).tolist())
    moved = np.stack([sums[name].to_numpy() for name in _PARTS], axis=1) * UNIT
    moved /= np.maximum(n, 1)[:, None]
    net = _start(np.random.default_rng(SEED))
    flat, rest = _flat(net), (at >= 0) & (at < BUCKETS)
    flat[-1 - at[at < 0]] += moved[at < 0]
    _unflat(net, flat)
    counts = np.zeros((2, BUCKETS), np.float32)
    counts[:, at[rest]] = clean[rest], toxic[rest]
    net.embedding[at[rest]] = (net.embedding[at[rest]] + moved[rest]).astype(np.float32)
    net.embedding[:, 0] += _log_odds(counts, sizes)
    return net, languages


def _judged(net: Network, rows: DataFrame, wanted: list[int] | None = None) -> dict[int, float]:
    """best_threshold by language of the (key, toxic, text) rows; ALL_TEXTS for all together.

    Only what has both classes gets one. Texts of other languages than those wanted are left aside.
    """
    known = rows.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(known.value)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                split = [words_of(text) for text in batch.column(1).to_pylist()]
                languages = [language_of(words) for words in split]
                own = [i for i, place in enumerate(languages) if wanted is None or place in wanted]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(own, pa.int32())),
                     pa.array([languages[i] for i in own], pa.int32()),
                     pa.array(scorer.logits([split[i] for i in own]), pa.float64())],
                    ["toxic", "language", "logit"])

    return ranked_thresholds(
        rows.select("toxic", "text").mapInArrow(run, "toxic int, language int, logit double"))


def ranked_thresholds(found: DataFrame) -> dict[int, float]:
    """best_threshold by language of (toxic, language, logit) rows, the same as in one place.

    Texts above a logit are the sums of the steps above it and of the rows above it in its own step,
    so no task ranks a whole language and the driver gets the thresholds alone.
    """
    counts = cut(found.groupBy("language", "logit").agg(
        F.sum("toxic").alias("hit"), F.count("toxic").alias("mass")))
    counts = counts.select(
        F.explode(F.array("language", F.lit(ALL_TEXTS))).alias("language"), "logit", "hit",
        "mass").where("language != -1").groupBy("language", "logit").agg(
        F.sum("hit").alias("hit"), F.sum("mass").alias("mass")).withColumn(
        "step", F.floor(F.col("logit") / LOGIT_STEP))

    whole = Window.partitionBy("language")
    down = whole.orderBy(F.desc("step"))
    above = down.rowsBetween(Window.unboundedPreceding, -1)
    steps = counts.groupBy("language", "step").agg(
        F.sum("hit").alias("hits"), F.sum("mass").alias("masses"), F.max("logit").alias("top"))
    steps = steps.select(
        "language", "step", F.sum("hits").over(whole).alias("toxic"),
        F.sum("masses").over(whole).alias("total"), F.lead("top").over(down).alias("next"),
        *(F.coalesce(F.sum(name).over(above), F.lit(0)).alias(name) for name in ("hits", "masses"))
    ).where("toxic > 0 and toxic < total")

    inside = Window.partitionBy("language", "step").orderBy(F.desc("logit"))
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    places = counts.join(steps, ["language", "step"]).select(
        "language", "logit",
        (2 * (F.col("hits") + F.sum("hit").over(so_far))
         / (F.col("masses") + F.sum("mass").over(so_far) + F.col("toxic"))).alias("f1"),
        F.coalesce(F.lead("logit").over(inside), "next", F.col("logit") - 1).alias("below"))
    best = places.groupBy("language").agg(F.max("f1").alias("best"))
    ends = places.join(F.broadcast(best), "language").where(
        F.col("f1") >= F.col("best") - F1_SLACK).groupBy("language").agg(
        F.max("logit").alias("high"), F.min("below").alias("low"))
    return {r["language"]: (r["high"] + r["low"]) / 2 for r in ends.collect()}


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        label: str = "toxic", shard_rows: int = SHARD_ROWS) -> Network:
    """Fit on all labelled documents, thresholds on fold 1, weights on the others; fold 0 is never read.

    Weights are trained in shards of about `shard_rows` labels and averaged (see _trained). A language
    of which fold 1 lacks a class gets its threshold from the other folds. Texts are shuffled by key,
    and none reaches the driver. Rows with a null key or label are left out; of contradicting labels
    the higher counts.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(
        F.col(key).alias("key")).agg(F.max(label).cast("int").alias("toxic"))
    known = known.where(fold_of("key") != 0)
    texts = docs.where(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    sizes = {(r["spare"], r["toxic"]): r["count"] for r in known.join(
        texts, "key", "left_semi").groupBy(
        (fold_of("key") == 1).alias("spare"), "toxic").count().collect()}
    if len({toxic for _, toxic in sizes}) < 2:
        return untrained()

    def part(spare: bool) -> tuple[DataFrame, int]:
        total = sum(n for (side, _), n in sizes.items() if side == spare)
        mine = fold_of("key") == 1 if spare else ~fold_of("key").isin(0, 1)
        shards = max(1, -(-total // shard_rows))
        return _labelled(texts.where(mine), known.where(mine), shards), shards

    learnt, shards = part(False)
    copies = tuple(min(shards, max(1, -(-CLASS_ROWS * shards // max(1, sizes.get((False, c), 0)))))
                   for c in (0, 1))
    net, languages = _trained(_dealt(learnt, shards, copies), copies)
    if not net.out.any():
        return net
    found = _judged(net, part(True)[0])
    if ALL_TEXTS not in found:
        found = _judged(net, learnt)
    elif lacking := [place for place in languages if place not in found]:
        found = {**_judged(net, learnt, lacking), **found}
    net.common = found.pop(ALL_TEXTS)
    net.thresholds = found
    return net


def score_documents(docs: DataFrame, network: Network, text: str = "text",
                    keep: list[str] | None = None) -> DataFrame:
    """(row, score, predicted) of every document; row holds its columns, or `keep`.

    Null and empty texts are scored as a text without words. Repeated rows each get a score; an
    empty table gives an empty result.
    """
    known = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(known.value)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                scores = scorer.scores(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(scores, pa.float64()),
                     pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                    names=["row", "score", "predicted"])

    rows = docs.select(columns_in_one(docs, keep).alias("row"),
                       F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, T.StructType([
        rows.schema["row"], T.StructField("score", T.DoubleType()),
        T.StructField("predicted", T.IntegerType())]))


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id",
             text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) of every document; held_out rows were never learnt from."""
    scored = score_documents(docs, fit(docs, labels, key, text), text, keep=[key])
    return scored.select(F.col("row").getField(key).alias(key), "score", "predicted").select(
        key, (fold_of(key) == 0).alias("held_out"), "score", "predicted")


def without_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """The documents that are not predicted toxic."""
    scored = score_documents(docs, fit(docs, labels, key, text), text)
    return scored.where("predicted = 0").select("row.*")
