"""Main text of web pages by equivalence-class template deduction.

A page is a sequence of tokens: opening tags and text blocks, each told apart by the path of elements
it stands in. Over the pages of one host every token has an occurrence vector (how often it occurs in
each page). Tokens with equal vectors form an equivalence class; a class is valid if enough pages and
tokens support it. The class present in all pages is the template's root; further valid classes are
nested in the gap of the class above that holds all their tokens. What lies between template tokens
are slots, and the text of the page's own slots is extracted.

Vectors are never gathered: a vector is the exclusive-or of a hash of (page, count) over the pages,
which Spark aggregates with map-side combine.

A check follows. Elements say what they are for: menus, headers, footers, sidebars, notices, adverts,
forms, scripts and reader comments are left out of the slots, and where a page marks its article, what
lies outside of the mark is too. Text inside a marked article always stays, also when other pages
repeat it; no slot is dropped for its length.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.shared import cut
from wakeline.operators.joins import salted_join

#: A valid class occurs in this many pages and in this share of the host's pages, with so many
#: tokens; pages of equal content count once. The share bounds a host's template by the length of its pages.
LEAST_PAGES = 3
LEAST_SHARE = 0.3
LEAST_TOKENS = 2
#: Up to this many repeated contents are named to every task; more are joined by their hash.
BROADCAST_CONTENTS = 500_000
#: Templates of up to this many tokens in all are sent to every task; others are joined by host.
BROADCAST_TOKENS = 1_000_000
#: Tags that end within so many characters are read by one expression, longer ones quote by quote.
TAG_CHARS = 16_384
SLICE_ROWS = 500

_TAG = re.compile(
    r"<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_START = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_QUOTE_OR_END = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(
    r"([^\s=/\"'>]+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")

# Elements by what they do to text; fixed by the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption center col colgroup dd details dialog dir div"
    " dl dt fieldset figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 head header"
    " hgroup hr html legend li link main menu meta nav ol optgroup option p pre search section"
    " summary table tbody td tfoot th thead title tr ul".split())
_SCOPE = frozenset(
    "article aside body details dialog div fieldset figure footer form header html main nav ol"
    " search section table td th ul dl blockquote".split())
# An element of this kind ends an open one of the same set within its scope.
_SIBLINGS = {name: group for group in (
    frozenset(["li"]), frozenset(["dt", "dd"]), frozenset(["tr"]), frozenset(["td", "th"]),
    frozenset(["option", "optgroup"]), frozenset(["thead", "tbody", "tfoot"])) for name in group}

# Elements, roles and class words that mark what is not the article.
_LEFT_OUT = frozenset(
    "nav footer aside form button select textarea input label script style noscript template svg"
    " math iframe object embed canvas audio video map head title dialog menu search noembed"
    " noframes xmp".split())
_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form"
    " toolbar".split())
_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising advertorial sponsor sponsored promo promos"
    " promotion banner sidebar nav navbar navigation menu menus breadcrumb breadcrumbs footer"
    " cookie cookies consent gdpr notice notices notification notifications alert alerts popup"
    " modal overlay newsletter subscribe subscription signup login register paywall share sharing"
    " social related recommended recommendations comment comments commentlist disqus reply replies"
    " respond widget widgets toolbar pagination pager copyright disclaimer skip search".split())
_OUTER_WORDS = frozenset("header masthead topbar".split())
_MAIN_NAMES = frozenset("article content main post entry story".split())
_REMARKS = frozenset("comment comments commentlist reply replies".split())
# A class name that starts so speaks of the page's layout, not of its element.
_LAYOUT = frozenset("has with without no is".split())


@dataclass
class Block:
    """A text block: its words, where it stands and whether it may belong to the article."""

    text: str
    token: int
    left_out: bool
    main: bool
    linked: int


@dataclass
class _Open:
    name: str
    path: int
    left_out: bool
    main: bool


def _hash(*parts) -> int:
    """A signed 64-bit name."""
    value = xxhash.xxh3_64_intdigest("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), entities.unescape("".join(values)))
    return found


def _named(names: str, words: frozenset[str]) -> bool:
    """Whether a class name or id begins or ends with one of the words."""
    for name in names.split():
        parts = [part.lower() for part in _WORD.findall(name)]
        if parts and parts[0] not in _LAYOUT and (parts[0] in words or parts[-1] in words):
            return True
    return False


def _purpose(name: str, attributes: dict[str, str], inside: _Open) -> tuple[bool, bool]:
    """(left out, main) of an element inside another."""
    role = attributes.get("role", "").lower()
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    main = name in ("article", "main") or role == "main" or (
        attributes.get("itemprop", "").lower() == "articlebody")
    if inside.left_out:
        return True, False
    if name in ("html", "body"):
        return False, False
    if main and not _named(names, _REMARKS):
        return False, True
    hidden = ("hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"
              or "display:none" in attributes.get("style", "").replace(" ", "").lower())
    if name in _LEFT_OUT or role in _ROLES or hidden:
        return True, False
    if not inside.main and (name == "header" or _named(names, _OUTER_WORDS)):
        return True, False
    content = any(part.lower() in _MAIN_NAMES for part in names.split())
    if _named(names, _REMARKS) or not content and _named(names, _WORDS):
        return True, False
    return False, inside.main


def _end_of_tag(html: str, at: int, unclosed: set[int]) -> int:
    """Place of the first '>' outside quotes; -1 if a quote or the tag never ends.

    Quotes from which no end was found are remembered, so that no part of a page is searched anew
    for each tag.
    """
    tried = []
    while (found := _QUOTE_OR_END.search(html, at)) is not None:
        at = found.start()
        if html[at] == ">":
            return at
        if at in unclosed:
            break
        tried.append(at)
        at = html.find(html[at], at + 1) + 1
        if not at:
            break
    unclosed.update(tried)
    return -1


def parse(html: str | None) -> tuple[list[int], list[Block]]:
    """Tokens of a page in order (tags and text blocks) and its text blocks."""
    tokens: list[int] = []
    blocks: list[Block] = []
    stack = [_Open("", 0, False, False)]
    # Places in the stack: by element name, and of all elements that bound a scope.
    opened: dict[str, list[int]] = {}
    scopes = [0]
    # Pieces of the block at hand: those that may be kept, and those left out.
    pieces: tuple[list[str], list[str]] = [], []
    linked, links, main = 0, 0, False
    html = html or ""

    def end_block() -> None:
        nonlocal linked, main
        for left_out, parts in enumerate(pieces):
            text = " ".join("".join(parts).split()) if parts else ""
            if text:
                token = _hash("text", stack[scopes[-1]].path, text)
                tokens.append(token)
                blocks.append(Block(text, token, bool(left_out), main, linked))
            parts.clear()
        linked, main = 0, False

    def put(raw: str) -> None:
        nonlocal linked, main
        if raw:
            text = entities.unescape(raw) if "&" in raw else raw
            pieces[stack[-1].left_out].append(text)
            main |= stack[-1].main and bool(text.strip())
            if links:
                linked += len("".join(text.split()))

    def close(names: frozenset[str], anywhere: bool) -> None:
        nonlocal links
        at = max((opened[name][-1] for name in names if opened.get(name)), default=0)
        if not at or not anywhere and at < scopes[-1]:
            return
        for element in stack[at:]:
            opened[element.name].pop()
            links -= element.name == "a"
        del stack[at:]
        while scopes[-1] >= at:
            scopes.pop()

    at, size, ahead = 0, len(html), -1
    unclosed: set[int] = set()
    while at < size:
        start = html.find("<", at)
        if start < 0:
            put(html[at:])
            break
        put(html[at:start])
        if html.startswith("<!--", start):
            found = html.find("-->", start + 2)
            at = found + 3 if found >= 0 else size
            continue
        if ahead < start:
            ahead = html.find(">", start)
        if ahead < 0:
            put(html[start:])
            break
        match = _TAG.match(html, start, start + TAG_CHARS)
        if match is not None:
            at = match.end()
            if match[2] is None:
                continue  # a declaration
            text = match[3]
        elif html[start + 1] in "!?":
            at = ahead + 1
            continue
        else:
            match = _START.match(html, start)
            if match is None:
                put("<")
                at = start + 1
                continue
            # A quote that never ends is none.
            end = _end_of_tag(html, match.end(), unclosed)
            at = (end if end >= 0 else html.find(">", match.end())) + 1
            text = html[match.end():at - 1]
        name = match[2].lower()
        if name in _BLOCK:
            end_block()
        if match[1]:
            if name == "p" and not any(e.name == "p" for e in stack[-8:]):
                continue
            close(frozenset([name]), name in _SCOPE)
            continue
        if name in _BLOCK and name not in ("br", "link", "meta"):
            close(frozenset(["p"]), False)
        if name in _SIBLINGS:
            close(_SIBLINGS[name], False)
        attributes = _attributes(text) if "=" in text or "hidden" in text.lower() else {}
        above = stack[-1]
        if name in _BLOCK and name != "br":
            path = _hash(above.path, name, attributes.get("class", ""))
            tokens.append(path)
        else:
            path = above.path
        if name in _RAW:
            found = re.compile(f"</{re.escape(name)}(?![a-zA-Z0-9-])[^>]*>?", re.I).search(html, at)
            at = found.end() if found else size
            continue
        if name in _VOID or text.endswith("/") and name in ("path", "rect", "circle", "use"):
            continue
        opened.setdefault(name, []).append(len(stack))
        if name in _SCOPE:
            scopes.append(len(stack))
        stack.append(_Open(name, path, *_purpose(name, attributes, above)))
        links += name == "a"
    end_block()
    return tokens, blocks


@dataclass
class Template:
    """Ordered root tokens of a host's pages and, by token, the class it belongs to."""

    root: list[int]
    class_of: dict[int, int]

    @classmethod
    def nested(cls, tokens: list[int], classes: list[int], places: list[float],
               pages: list[int]) -> Template:
        """Nest a host's valid classes; those that do not fit into one gap are dropped."""
        by_class: dict[int, list[tuple[float, int]]] = {}
        support: dict[int, int] = {}
        for token, number, place, page_count in zip(tokens, classes, places, pages):
            by_class.setdefault(number, []).append((place, token))
            support[number] = page_count
        order = sorted(by_class, key=lambda c: (-support[c], -len(by_class[c]), c))
        if not order:
            return cls([], {})
        for members in by_class.values():
            members.sort()
        kept: list[int] = []
        for number in order:
            low, high = by_class[number][0][0], by_class[number][-1][0]
            # Every class above must have all of these tokens in one of its gaps.
            if all(sum(p < low for p, _ in by_class[c]) == sum(p < high for p, _ in by_class[c])
                   for c in kept):
                kept.append(number)
        return cls([t for _, t in by_class[order[0]]],
                   {t: number for number in kept for _, t in by_class[number]})

    def slots(self, tokens: list[int], blocks: list[Block]) -> list[int] | None:
        """The slot of each block (-1 for template text); None if the page breaks the order."""
        wanted = set(self.root)
        if [t for t in tokens if t in wanted] != self.root:
            return None
        out, slot, texts = [], 0, {id(b): b for b in blocks}
        waiting = iter(texts.values())
        following = next(waiting, None)
        for token in tokens:
            if following is not None and token == following.token:
                out.append(-1 if token in self.class_of else slot)
                following = next(waiting, None)
            if token in self.class_of:
                slot += 1
        return out


def main_text(html: str | None, template: Template | None) -> str:
    """Text of the article's blocks, joined by one space; empty if there is none.

    The template places the slots: its own text goes, what lies between is the page's. Without a
    template the whole page is one slot. Of the slots, those with a marked block are the article,
    or all where the page marks none. The elements' purposes are checked last: what they leave out
    goes, so does what a marking page has outside of its mark, and on other pages a block that is
    nothing but links. Template text inside the mark is the article's own and stays.
    """
    tokens, blocks = parse(html)
    slots = template.slots(tokens, blocks) if template and template.root else None
    if slots is None:
        slots = [0] * len(blocks)
    marked = {slot for slot, b in zip(slots, blocks) if b.main and not b.left_out}
    placed = [b for slot, b in zip(slots, blocks)
              if (slot in marked if marked else slot >= 0) or b.main]
    return " ".join(b.text for b in placed if not b.left_out and (
        b.main if marked else b.linked < len(b.text.replace(" ", ""))))


def host_of(url: str):
    """Lower-case host of a URL column; empty for null and for what is no URL."""
    return F.coalesce(F.regexp_extract(
        F.lower(F.col(url)), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def _distinct_contents(pages: DataFrame) -> DataFrame:
    """(html, host) of each distinct page of a host; only repeated ones are shuffled."""
    content = F.xxhash64(F.col("html").isNull(), "html").alias("content")
    rows = pages.select("html", "host", content)
    repeated = cut(rows.groupBy("host", "content").count().where("count > 1").select(
        "host", "content"))
    number = repeated.count()
    if not number:
        return rows.select("html", "host")
    named = F.broadcast(repeated) if number <= BROADCAST_CONTENTS else repeated
    copies = rows.join(named, ["host", "content"], "left_semi").groupBy("host", "content").agg(
        F.min("html").alias("html"))
    return rows.join(named, ["host", "content"], "left_anti").select("html", "host").union(
        copies.select("html", "host"))


def templates(pages: DataFrame) -> DataFrame:
    """(host, tokens, classes, places, pages): the valid classes of each host with a template.

    pages has the columns page_id, url, html, host. Pages of a host with equal html count as one, so
    that copies of a page do not make its own text a template. Tokens of too few pages are dropped before any
    grouping by host, so that a host gathers a number of tokens bounded by its pages' length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, int], list[int]] = {}
            for html, host in zip(batch.column(0), batch.column(1)):
                host, html = host.as_py(), html.as_py()
                tokens, _ = parse(html)
                page = _hash(html)
                first: dict[int, int] = {}
                for place, token in enumerate(tokens):
                    first.setdefault(token, place)
                counts = Counter(tokens)
                counts[0], first[0] = 1, -1  # stands for the page itself
                for token, count in counts.items():
                    entry = found.setdefault((host, token), [0, 0, 0])
                    entry[0] += 1
                    entry[1] ^= _hash(page, count)
                    entry[2] += first[token]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in found], pa.string()),
                 pa.array([k[1] for k in found], pa.int64()),
                 *(pa.array([v[i] for v in found.values()], pa.int64()) for i in range(3))],
                names=["host", "token", "pages", "vector", "places"])

    parts = _distinct_contents(pages).mapInArrow(
        run, "host string, token bigint, pages bigint, vector bigint, places bigint")
    found = cut(parts.groupBy("host", "token").agg(
        F.sum("pages").alias("pages"), F.bit_xor("vector").alias("vector"),
        (F.sum("places") / F.sum("pages")).alias("place")).where(F.col("pages") >= LEAST_PAGES))
    hosts = found.where("token = 0").select("host", F.col("pages").alias("of"))
    likely = found.where("token <> 0").join(hosts, "host").where(
        F.col("pages") >= LEAST_SHARE * F.col("of"))
    # Classes (equal vectors) with enough tokens, then all of a host's classes.
    one = F.struct("token", "vector", "place", "pages")
    classes = likely.groupBy("host", "vector", "pages").agg(
        F.collect_list(one).alias("c")).where(F.size("c") >= LEAST_TOKENS)
    gathered = classes.groupBy("host").agg(
        F.sort_array(F.flatten(F.collect_list("c"))).alias("m"))
    return gathered.select(
        "host", *(F.col(f"m.{field}").alias(name) for field, name in (
            ("token", "tokens"), ("vector", "classes"), ("place", "places"), ("pages", "pages"))))


def extract_text(pages: DataFrame, key: str = "page_id", url: str = "url",
                 html: str = "html") -> DataFrame:
    """(key, url, text, n_chars) of every page.

    Null html gives an empty text; pages without a usable URL share one nameless host; repeated rows
    each get a result; an empty table gives an empty result; extra columns are ignored.
    """
    rows = pages.select(
        F.col(key).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.col(html).cast("string").alias("html"), host_of(url).alias("host"))
    known = cut(templates(rows)).withColumnRenamed("pages", "support")
    # The joined tokens are counted first: only a small table is sent to every task.
    total = known.agg(F.sum(F.size("tokens"))).first()[0] or 0
    if total <= BROADCAST_TOKENS:
        joined = rows.join(F.broadcast(known), "host", "left")
    else:
        joined = salted_join(rows, known, ["host"], ["page_id", "url"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[str, Template | None] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                texts = []
                for row in range(batch.num_rows):
                    host = batch.column(2)[row].as_py()
                    if host not in made:
                        if len(made) >= 10_000:
                            made.clear()
                        parts = [batch.column(i)[row].as_py() for i in range(3, 7)]
                        made[host] = None if parts[0] is None else Template.nested(*parts)
                    texts.append(main_text(batch.column(1)[row].as_py(), made[host]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(7), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    names=[key, "url", "text", "n_chars"])

    return joined.select("page_id", "html", "host", "tokens", "classes", "places", "support",
                         "url").mapInArrow(
        run, f"`{key}` bigint, url string, text string, n_chars bigint")
