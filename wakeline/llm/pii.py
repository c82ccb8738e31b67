"""Personal data by fixed patterns and a skip-chain conditional random field.

The patterns of four kinds give the base spans. Candidate tokens (runs around an "@", phrases of
digits) are then labelled by a conditional random field over each document: neighbours form a chain,
and equal or similar tokens anywhere in the document are linked by skip edges, so that a token whose
own look is doubtful takes the label of its clear repetitions. Marginals come from loopy message
passing; tokens under a base span are fixed to its kind. Tokens labelled with enough certainty add
spans.

The model is trained piecewise: token weights by softmax regression and edge weights from label
agreement, both on the base labels of all tokens of all different texts. The cues that decide the
base label are hidden in half of the training copies, so that the look of a token must speak as well.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.llm.shared import columns_in_one

# Kinds in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")
OUTSIDE = len(KINDS)

# Fixed patterns of the base spans.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match never starts inside a run of digits, as the same match would fit from the run's start.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")

# Candidates: what may be personal data though no pattern fits.
_PHRASE = re.compile(r"(?<![^\W_])[+(]?[0-9](?:[0-9().\x20-]*[0-9])?(?![^\W_])")
_SPACED = re.compile(r"[^\x20]+")
_HOST = re.compile(r"[A-Za-z0-9.-]*")
LEAST_DIGITS = 7
#: A word with so many digits stands for itself, also where a space joins it to other digits.
LONG_DIGITS = 13

#: A token joins the spans with at least this probability of a kind.
CERTAIN = 0.9
ROUNDS = 15
CUES = 64
SLICE_ROWS = 1_000

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield 0, start, found.end()
            end = found.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of the fixed patterns, by kind and start; offsets in code points."""
    if not _MARK.search(text):
        return []
    spans = list(_emails(text))
    for match in _IP.finditer(text):
        if all(map(_small, match[0].split("."))):
            spans.append((1, *match.span()))
    for match in _CARD.finditer(text):
        digits = _only_digits(match[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= len(_only_digits(match[0])) <= 15:
                spans.append((3, *match.span()))
    return spans


def candidates(text: str) -> list[tuple[int, int]]:
    """Ranges of the tokens the field labels, in order and disjoint."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        stop = _HOST.match(text, at + 1).end()
        while stop > at + 1 and text[stop - 1] in ".-":
            stop -= 1
        if start < at and stop > at + 1:
            found.append((start, stop))
            end = stop
        at = text.find("@", max(at + 1, end))
    around = iter([*found, (len(text), len(text))])
    taken, both = next(around), list(found)
    for match in _PHRASE.finditer(text):
        while taken[1] <= match.start():
            if taken[0] == len(text):
                break
            taken = next(around)
        if match.end() <= taken[0]:
            both += [(a, b) for a, b in _numbers(text, *match.span())
                     if len(_only_digits(text[a:b])) >= LEAST_DIGITS]
    return sorted(both)


def _numbers(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """A phrase of digits, cut around words long enough to be a number of their own."""
    first = start
    for word in _SPACED.finditer(text, start, end):
        if len(_only_digits(word[0])) >= LONG_DIGITS:
            if first < word.start():
                yield first, word.start() - 1
            yield word.span()
            first = word.end() + 1
    if first < end:
        yield first, end


def _cue(text: str, start: int) -> int:
    """Bucket of the word before a token; 0 without one."""
    before = text[max(0, start - 40):start].split()
    word = "".join(c for c in before[-1].lower() if c.isalpha()) if before else ""
    return 1 + zlib.crc32(word.encode()) % (CUES - 1) if word else 0


_DECISIVE = slice(1, 6)
_LOOK = 24


def features(text: str, start: int, end: int) -> tuple[np.ndarray, int]:
    """What a token looks like; the decisive cues stand in places 1 to 5."""
    token = text[start:end]
    digits = _only_digits(token)
    local, mark, host = token.partition("@")
    parts = token.split(".")
    look = np.zeros(_LOOK)
    look[0] = 1
    look[1] = bool(mark) and bool(_DOMAIN.fullmatch(host))
    look[2] = len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts) and all(
        map(_small, parts))
    look[3] = 13 <= len(digits) <= 19 and luhn(digits)
    look[4] = token.startswith("+") and 9 <= len(digits) <= 15
    look[5] = token.startswith("+")
    look[6] = bool(mark)
    look[7] = bool(mark) and "." in host
    look[8] = bool(mark) and any("0" <= c <= "9" for c in local)
    look[9] = not mark and len(parts) == 4
    look[10] = not mark and len(parts) > 1
    look[11] = not mark and "(" in token
    look[12] = not mark and "-" in token
    look[13] = not mark and " " in token
    for place, most in enumerate((7, 9, 11, 12, 14, 15, 16, 19)):
        if not mark and len(digits) <= most:
            look[14 + place] = 1
            break
    look[22] = not mark and len(digits) > 19
    look[23] = not mark and digits == token
    return look, _cue(text, start)


def _vector(looks: list[np.ndarray], cues: list[int]) -> np.ndarray:
    rows = np.zeros((len(looks), _LOOK + CUES))
    rows[:, :_LOOK] = looks
    rows[np.arange(len(cues)), _LOOK + np.array(cues, int)] = 1
    return rows


def labels_under(spans: list[Span], tokens: list[tuple[int, int]]) -> np.ndarray:
    """Kind of the base span that overlaps each token (the first listed), else OUTSIDE.

    Spans of one kind and tokens are both in order, so each kind needs one pass.
    """
    out = np.full(len(tokens), OUTSIDE)
    for kind in reversed(range(len(KINDS))):
        ranges = np.array([s[1:] for s in spans if s[0] == kind], int).reshape(-1, 2)
        if len(ranges) and len(tokens):
            bounds = np.array(tokens)
            place = np.searchsorted(ranges[:, 1], bounds[:, 0], side="right")
            inside = place < len(ranges)
            inside[inside] = ranges[place[inside], 0] < bounds[inside, 1]
            out[inside] = kind
    return out


def keys_of(token: str) -> list[str]:
    """Names under which a token equals or resembles others: its letters and digits, and its stem."""
    if "@" in token:
        local, _, host = token.lower().partition("@")
        return [f"{local}@{host}", f"{local}@"]
    digits = _only_digits(token)
    return [digits, digits[-7:]]


def edges_of(tokens: list[str], starts: list[int], reach: int = 60) -> tuple[np.ndarray, ...]:
    """(left, right, kind) edges: 0 chain, 1 skip. A repeated token is linked to its last mention.

    Linking each mention to the one before keeps edges in proportion to tokens, and messages
    still pass along all mentions.
    """
    pairs: dict[tuple[int, int], int] = {}
    for i in range(1, len(tokens)):
        if starts[i] - starts[i - 1] <= reach:
            pairs[i - 1, i] = 0
    last: dict[str, int] = {}
    for i, token in enumerate(tokens):
        for key in keys_of(token):
            if key in last and last[key] != i:
                pairs[last[key], i] = 1
            last[key] = i
    ends = np.array(list(pairs), int).reshape(-1, 2)
    return ends[:, 0], ends[:, 1], np.array(list(pairs.values()), int)


@dataclass
class Field:
    """Weights of the field: tokens (features x labels), and log potentials by edge kind."""

    weights: np.ndarray
    edges: np.ndarray

    def marginals(self, unary: np.ndarray, left: np.ndarray, right: np.ndarray,
                  kind: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
        """Label probabilities by damped loopy sum-product, all messages of a round at once."""
        n, labels = unary.shape
        source = np.concatenate([left, right])
        target = np.concatenate([right, left])
        back = np.concatenate([np.arange(len(left)) + len(left), np.arange(len(left))])
        potential = self.edges[np.concatenate([kind, kind])]
        messages = np.zeros((len(source), labels))
        for _ in range(rounds if len(source) else 0):
            belief = unary.copy()
            np.add.at(belief, target, messages)
            out = (belief[source] - messages[back])[:, :, None] + potential
            top = out.max(axis=1, keepdims=True)
            new = np.log(np.exp(out - top).sum(axis=1)) + top[:, 0]
            new -= new.max(axis=1, keepdims=True)
            change = np.abs(new - messages).max()
            messages = 0.5 * messages + 0.5 * new
            if change < 1e-4:
                break
        belief = unary.copy()
        np.add.at(belief, target, messages)
        belief = np.exp(belief - belief.max(axis=1, keepdims=True))
        return belief / belief.sum(axis=1, keepdims=True)

    def added_spans(self, text: str, base: list[Span]) -> list[Span]:
        """Spans of tokens that no base span touches and that the field labels with certainty."""
        ranges = candidates(text)
        given = labels_under(base, ranges)
        if not (given == OUTSIDE).any():
            return []
        look = [features(text, *r) for r in ranges]
        unary = _vector([f for f, _ in look], [c for _, c in look]) @ self.weights
        clear = np.flatnonzero(given != OUTSIDE)
        unary[clear] = -30.0
        unary[clear, given[clear]] = 0.0
        left, right, kind = edges_of([text[a:b] for a, b in ranges], [a for a, _ in ranges])
        chances = self.marginals(unary, left, right, kind)
        best = chances.argmax(axis=1)
        sure = (best != OUTSIDE) & (given == OUTSIDE) & (chances.max(axis=1) >= CERTAIN)
        return [(int(best[i]), *ranges[i]) for i in np.flatnonzero(sure)]

    def spans(self, text: str | None) -> tuple[list[Span], list[Span]]:
        """(base, all) spans of a whole text, by kind and start."""
        text = text or ""
        base = base_spans(text)
        if not _MARK.search(text):
            return base, base
        return base, sorted(base + self.added_spans(text, base))


def softmax_regression(rows: np.ndarray, labels: np.ndarray, weight: np.ndarray, steps: int = 300,
                       rate: float = 0.5, decay: float = 1e-3) -> np.ndarray:
    """weight says how often each row occurs."""
    share = (weight / weight.sum())[:, None]
    weights = np.zeros((rows.shape[1], len(KINDS) + 1))
    wanted = np.eye(len(KINDS) + 1)[labels]
    for step in range(steps):
        scores = rows @ weights
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        chances = scores / scores.sum(axis=1, keepdims=True)
        weights -= rate * (rows.T @ (share * (chances - wanted)) + decay * weights)
    return weights


def train(looks: np.ndarray, labels: np.ndarray, pair_counts: np.ndarray,
          weight: np.ndarray) -> Field:
    """Token and edge weights; without tokens the field adds nothing."""
    labels_n = len(KINDS) + 1
    if not len(looks):
        weights = np.zeros((_LOOK + CUES, labels_n))
        weights[0, OUTSIDE] = 10.0
        return Field(weights, np.zeros((2, labels_n, labels_n)))
    hidden = looks.copy()
    hidden[:, _DECISIVE] = 0
    weights = softmax_regression(np.concatenate([looks, hidden]), np.tile(labels, 2),
                                 np.tile(weight, 2))
    edges = np.zeros((2, labels_n, labels_n))
    for kind in range(2):
        both = pair_counts[kind] + pair_counts[kind].T + 1.0
        share = both / both.sum()
        alone = share.sum(axis=1)
        edges[kind] = np.log(share / np.outer(alone, alone))
    return Field(weights, edges)


def _token_counts(text: str) -> tuple[bytes, Counter[int]]:
    """A digest of the text and how often each sort of its tokens (code >= 0) and edges occurs."""
    ranges = candidates(text)
    given = labels_under(base_spans(text), ranges).tolist()
    counts: Counter[int] = Counter()
    for (start, end), label in zip(ranges, given):
        look, cue = features(text, start, end)
        bits = int.from_bytes(np.packbits(look.astype(bool)).tobytes(), "big")
        counts[(bits * CUES + cue) * 8 + label] += 1
    for a, b, k in zip(*(ends.tolist() for ends in edges_of(
            [text[start:end] for start, end in ranges], [start for start, _ in ranges]))):
        counts[-1 - ((k * 8 + given[a]) * 8 + given[b])] += 1
    digest = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
    return digest, counts


def fit(docs: DataFrame, text: str = "text") -> Field:
    """Train on every token of all different texts; copies of a text count once.

    Tokens are counted by what the model sees of them (look, cue and base label) and edges by kind
    and labels, in Spark. The driver receives one row for each sort that occurs: their number hangs on
    the features, not on the documents.
    """
    marked = docs.select(F.col(text).cast("string").alias("text")).where(
        F.col("text").rlike("[0-9@]"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pair for pair in (_token_counts(value.as_py()) for value in batch.column(0))
                     if pair[1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest for digest, _ in found], pa.binary()),
                 pa.array([list(counts) for _, counts in found], pa.list_(pa.int64())),
                 pa.array([list(counts.values()) for _, counts in found], pa.list_(pa.int64()))],
                names=["digest", "code", "n"])

    kinds = "digest binary, code array<bigint>, n array<bigint>"
    once = marked.mapInArrow(run, kinds).dropDuplicates(["digest"])
    sorts = once.select(F.inline(F.arrays_zip("code", "n"))).groupBy("code").agg(
        F.sum("n").alias("n")).orderBy("code").collect()
    edges = np.zeros((2, len(KINDS) + 1, len(KINDS) + 1))
    looks, cues, labels, weight = [], [], [], []
    for row in sorts:
        code = row["code"]
        if code < 0:
            code = -1 - code
            edges[code >> 6, code >> 3 & 7, code & 7] = row["n"]
            continue
        labels.append(code & 7)
        cues.append(code // 8 % CUES)
        bits = (code // 8 // CUES).to_bytes(_LOOK // 8, "big")
        looks.append(np.unpackbits(np.frombuffer(bits, np.uint8)).astype(float))
        weight.append(row["n"])
    vectors = _vector(looks, cues) if looks else np.zeros((0, _LOOK + CUES))
    return train(vectors, np.array(labels, int), edges, np.array(weight, float))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the first counts."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find_personal_data(docs: DataFrame, text: str = "text", field: Field | None = None,
                       keep: list[str] | None = None) -> DataFrame:
    """(row, counts, base, spans, redacted) of every document; row holds its columns, or `keep`.

    counts are the numbers of base spans by kind; base and spans list kind:start:end. Null texts
    are searched as empty ones and stay null in redacted. Repeated rows each get a result; an empty
    table gives an empty result.
    """
    field = field or fit(docs, text)
    known = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Field = known.value
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                counts, base_out, all_out, clean = [], [], [], []
                for value in batch.column(1).to_pylist():
                    base, spans = model.spans(value)
                    counts.append([sum(s[0] == kind for s in base) for kind in range(len(KINDS))])
                    base_out.append(listed(base))
                    all_out.append(listed(spans))
                    clean.append(redacted(value, spans) if spans else value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(counts, pa.list_(pa.int64())),
                     pa.array(base_out, pa.string()), pa.array(all_out, pa.string()),
                     pa.array(clean, pa.string())],
                    names=["row", "counts", "base", "spans", "redacted"])

    rows = docs.select(columns_in_one(docs, keep).alias("row"),
                       F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, T.StructType([
        rows.schema["row"], T.StructField("counts", T.ArrayType(T.LongType())),
        *(T.StructField(name, T.StringType()) for name in ("base", "spans", "redacted"))]))


def span_digests(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 field: Field | None = None) -> DataFrame:
    """(key, n_<kind>..., base_sha256, spans) of every document."""
    found = find_personal_data(docs, text, field, keep=[key])
    return found.select(
        F.col("row").getField(key).alias(key),
        *(F.col("counts")[i].alias(f"n_{kind}") for i, kind in enumerate(KINDS)),
        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def without_personal_data(docs: DataFrame, text: str = "text", n_chars: str = "n_chars",
                          field: Field | None = None) -> DataFrame:
    """The documents with every span replaced, and n_chars (if there is one) counted anew there.

    Rows without spans stay as they are.
    """
    found = find_personal_data(docs, text, field)
    columns = []
    for name in docs.columns:
        value = F.col("row").getField(name)
        if name == text:
            value = F.col("redacted")
        elif name == n_chars:
            kind = docs.schema[name].dataType
            value = F.when(F.col("spans") == "", value).otherwise(
                F.char_length("redacted").cast(kind))
        columns.append(value.alias(name))
    return found.select(*columns)
