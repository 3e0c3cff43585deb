"""Main text of raw pages: article structure first, then what a host repeats.

Pages are cut into blocks. Known boilerplate elements are set aside; the blocks of an ``article`` or ``main``
element, or else all that are left, are the page's own. These lose every run of tokens that the host repeats,
on every page. The runs come from suffix arrays over the token streams of the host's pages, one per host and
stretch of a task's pages: neighbours in the array that agree in a run's tokens hold the same run. A run is
repeated if pages of several distinct contents hold it, so copies of a page, or a passage that two pages quote,
are no boilerplate. Most runs stand on one page only: their keys, dealt to tasks as packed numbers, tell which
may be repeated. The arrays of several tasks meet in a count of fixed size per such run, combined in every task
before the shuffle; pages then look up their runs.
"""

from __future__ import annotations

import re
from collections import Counter
from hashlib import blake2b
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import FILTER_BITS, low_bits, may_hold
from riskweave.llm.shingles import mix, word_hashes
from riskweave.session import staged

#: Tokens of a repeated run, and about as many suffixes as are sorted or sent on at once.
RUN_TOKENS = 8
SUFFIXES_PER_TASK = 500_000
#: Runs whose keys are compared at once, about.
KEYS_PER_RANGE = 4_000_000
#: Distinct page contents of a host that make a run of theirs boilerplate.
CONTENTS = 3

# Elements by their part in a page, and names in class, id and role that mark boilerplate.
RAW_TEXT = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BOILERPLATE = {
    "head", "nav", "footer", "aside", "form", "button", "select", "option", "datalist", "dialog", "menu", "template",
    "svg", "canvas", "object", "audio", "video", "map", "label", "fieldset",
} | RAW_TEXT
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "del", "dfn", "em", "font", "i", "ins", "kbd",
    "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "data",
    "ruby", "rt", "rp",
}
#: Boilerplate elements that may also wrap a whole page: an article in them is one.
WRAPPERS = {"form", "fieldset", "header"}
# Names count whole: "has-sidebar" or "no-comments" tell of a page, "site-footer" or "share-buttons" are one.
_APART = r"comments?|commentlist|disqus|respond|reply|replies|related|ads?|advert[a-z]*|adsense|sponsor[a-z]*|promo[a-z]*"
_PARTS = rf"{_APART}|cookies?|consent|gdpr|newsletter|subscribe|subscription|signup|login|share|sharing|social|breadcrumbs?|popup|modal"
_HEADER = r"header|masthead"
_PLACES = (
    rf"{_HEADER}|banner|notice|alert|overlay|sidebar|sidenav|side|menu|nav|navbar|navigation|topbar|toolbar|footer|colophon"
    r"|widget|search|contentinfo|complementary|skip|hidden")
_OF = r"(?:(?:site|main|primary|secondary|global|top|bottom|post)[-_])?"
_TAIL = r"posts?|links?|buttons?|icons?|list|area|section|box|form|bar|container|wrapper|slot|unit|block|notice|banner"
MARKED = re.compile(rf"{_OF}(?:{_PARTS}|{_PLACES})(?:[-_](?:{_PARTS}|{_PLACES}))*|{_OF}(?:{_PARTS})(?:[-_](?:{_PARTS}|{_TAIL}))+")
#: Those whose articles are none of the page's own: comments, teasers, advertisements.
MARKED_APART = re.compile(rf"{_OF}(?:{_APART})(?:[-_](?:{_PARTS}|{_TAIL}))*")
#: Those of an article's own header.
MARKED_HEADER = re.compile(rf"{_OF}(?:{_HEADER})")
APART_ROLES = {"navigation", "complementary", "contentinfo"}
#: A start tag of these ends an open element of the listed kinds.
ENDS_OPEN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}

_TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE_NAME = re.compile(r"[^\s/>][^\s/>=]*")
_UNQUOTED = re.compile(r"[^\s>]*")
_BETWEEN = re.compile(r"[\s/]*")
_IS = re.compile(r"\s*=\s*")

ARTICLE, OPEN, ASIDE = 0, 1, 2
#: Set aside, but an article or main element below is the page's.
_WRAPPED = 3


def read_tag(html: str, at: int) -> tuple[list[tuple[str, str]], bool, int]:
    """Attributes of a tag from the end of its name on, whether it ends in "/>", and the place behind it.

    Every character is looked at once. A quote that is never closed ends at the tag's first ">", a stray quote
    is part of a name or value, a tag that the page ends in takes the rest.
    """
    found = []
    while True:
        gap = _BETWEEN.match(html, at)
        at = gap.end()
        if at >= len(html):
            return found, False, at
        if html[at] == ">":
            return found, gap[0].endswith("/"), at + 1
        name = _ATTRIBUTE_NAME.match(html, at)
        at, value = name.end(), ""
        if equals := _IS.match(html, at):
            at = equals.end()
            quote = html[at : at + 1]
            close = html.find(quote, at + 1) if quote and quote in "\"'" else -2
            if close >= 0:
                value, at = html[at + 1 : close], close + 1
            elif close == -1:
                close = html.find(">", at)
                return found, False, len(html) if close < 0 else close + 1
            else:
                text = _UNQUOTED.match(html, at)
                value, at = text[0], text.end()
        found.append((name[0].lower(), value.lower()))


def _kind_within(tag: str, values: list[tuple[str, str]], kind: int) -> int:
    """Kind of what an element with these attributes holds that stands in text of ``kind``."""
    if kind == ASIDE:
        return ASIDE
    # within an article nothing that is set aside holds another main text
    aside = ASIDE if kind == ARTICLE else _WRAPPED
    if tag in WRAPPERS:
        return kind if tag == "header" and kind == ARTICLE else aside  # an article's own header holds its title
    if tag in BOILERPLATE and not (tag == "label" and kind == ARTICLE):  # a form's labels go with the form
        return ASIDE
    is_main = tag in ("article", "main") or ("role", "main") in values
    inner = ARTICLE if is_main else kind
    if tag in ("html", "body", "main", "h1"):
        return inner
    for name, value in values:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return ASIDE
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return ASIDE
        if name == "role" and value in APART_ROLES:
            return ASIDE
    for name, value in values:
        for word in value.split() if name in ("class", "id", "role") else ():
            if MARKED_APART.fullmatch(word):
                if is_main and kind != ARTICLE:
                    continue
                return ASIDE  # in an article also another one: a comment
            if MARKED.fullmatch(word) and not is_main and not (kind == ARTICLE and MARKED_HEADER.fullmatch(word)):
                inner = aside
    return inner


def blocks(html: str) -> list[tuple[int, str]]:
    """(kind, text) of every block with text, in page order; references decoded, white space collapsed."""
    out: list[tuple[int, str]] = []
    text: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements and the kind of what they hold
    is_open: Counter[str] = Counter()  # how many of the stack have a name; a stray end tag costs nothing
    kind = OPEN

    def flush() -> None:
        whole = " ".join(unescape("".join(text)).split())
        if whole:
            out.append((ASIDE if kind == _WRAPPED else kind, whole))
        text.clear()

    def settle(new: int) -> int:
        if new != kind:
            flush()
        return new

    def close(k: int) -> int:
        is_open.subtract(name for name, _ in stack[k:])
        del stack[k:]
        return settle(stack[-1][1] if stack else OPEN)

    at = 0
    while (start := html.find("<", at)) >= 0:
        text.append(html[at:start])
        sign = html[start + 1 : start + 2]
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            at = len(html) if end < 0 else end + 3
            continue
        ending = sign == "/"
        name = _TAG_NAME.match(html, start + 1 + ending)
        if not name:
            if sign and sign in "!?/":
                end = html.find(">", start)
                at = len(html) if end < 0 else end + 1
            else:
                text.append("<")
                at = start + 1
            continue
        tag = name[0].lower()
        values, empty, at = read_tag(html, name.end())
        if tag not in INLINE:
            flush()
        if ending:
            if is_open[tag] > 0:
                kind = close(_last(stack, tag))
            continue
        if tag in VOID or empty and tag not in RAW_TEXT:
            continue
        ends = ENDS_OPEN.get(tag, () if tag in INLINE else ("p",))
        near = range(len(stack) - 1, max(-1, len(stack) - 4), -1)
        if ends and ends != ("p",):
            k = next((i for i in near if stack[i][0] in ends), None)
            if k is not None and all(s[0] in INLINE or s[0] in ends for s in stack[k:]):
                kind = close(k)
        elif ends and is_open["p"] > 0:
            k = len(stack) - 1
            while k >= 0 and stack[k][0] in INLINE:
                k -= 1
            if k >= 0 and stack[k][0] == "p":
                kind = close(k)
        if tag in RAW_TEXT:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
            end = html.find(">", end.end()) if end else -1
            at = len(html) if end < 0 else end + 1
            continue
        inner = _kind_within(tag, values, kind)
        stack.append((tag, inner))
        is_open[tag] += 1
        kind = settle(inner)
    text.append(html[at:])
    flush()
    return out


def _last(stack: list[tuple[str, int]], tag: str) -> int:
    """Place of the last open element of a name; what is passed over closes with it."""
    k = len(stack) - 1
    while stack[k][0] != tag:
        k -= 1
    return k


def _parsed(pages: DataFrame) -> DataFrame:
    """Per page: the text of its articles, if it has any; its own blocks; all tokens, the own first; a hash of all text."""
    schema = "page_id long, url string, main string, blocks array<string>, stream binary, n_tokens long, content long"
    types = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.binary(), pa.int64(), pa.int64()]
    names = ["page_id", "url", "main", "blocks", "stream", "n_tokens", "content"]

    def parse(batches):
        for batch in batches:
            rows = []
            for page, url, html in zip(*(batch.column(k).to_pylist() for k in range(3))):
                found = blocks(html or "")
                main = [t for kind, t in found if kind == ARTICLE]
                rest = [t for kind, t in found if kind == OPEN]
                decided = bool(main) or not rest
                # the page's own blocks come first in the stream, so that positions can be mapped back
                own = main or rest
                words = own + [t for kind, t in found if kind == ASIDE or main and kind == OPEN]
                tokens = word_hashes([" ".join(words).encode()])[0].astype(np.uint32) if words else np.empty(0, np.uint32)
                whole = " ".join(t for _, t in found).encode()
                content = int.from_bytes(blake2b(whole, digest_size=8).digest(), "little", signed=True)
                rows.append((page, url, " ".join(main) if decided else None, own or None,
                             tokens.tobytes(), tokens.size, content))
            columns = zip(*rows) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    raw = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return raw.mapInArrow(parse, schema).withColumns({"host": host, "page_key": F.monotonically_increasing_id()})


def suffix_array(streams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, tokens, owner, left): places of the joined streams in the order of the suffixes that begin there and
    reach to their own stream's end; per place its token, its stream and the tokens up to that end.

    By doubling: the order of the first 2d tokens follows from that of the first d, here and d places on.
    """
    sizes = np.array([s.size for s in streams])
    tokens = np.concatenate(streams)
    owner = np.repeat(np.arange(len(streams)), sizes)
    left = np.cumsum(sizes)[owner] - np.arange(tokens.size)
    rank = np.unique(tokens, return_inverse=True)[1] + 1  # 0 is a stream's end
    depth = 1
    while depth < sizes.max():
        after = np.zeros_like(rank)
        inside = np.flatnonzero(left > depth)
        after[inside] = rank[inside + depth]
        finer = np.unique(rank * (tokens.size + 1) + after, return_inverse=True)[1] + 1
        if finer.max() == rank.max():  # what is equal so far is equal to the end
            break
        rank, depth = finer, 2 * depth
    return np.argsort(rank, kind="stable"), tokens, owner, left


def _hashed_runs(tokens: np.ndarray, starts: np.ndarray, run: int) -> np.ndarray:
    total = np.full(starts.size, run, np.uint64)
    for d in range(run):
        total += mix(tokens[starts + d].astype(np.uint64) + np.uint64(d << 32))
    return mix(total).view(np.int64)


def _host_runs(streams: list[np.ndarray], contents: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """(content, run) of a host's streams, each pair once, from their suffix array."""
    order, tokens, owner, left = suffix_array(streams)
    order = order[left[order] >= run]
    new = np.ones(order.size, bool)
    new[1:] = False
    for d in range(run):
        new[1:] |= tokens[order[1:] + d] != tokens[order[:-1] + d]
    number = np.cumsum(new) - 1  # suffixes that share a run are neighbours
    held = np.unique(np.stack([number, contents[owner[order]]]), axis=1)
    return held[1], _hashed_runs(tokens, order[new], run)[held[0]]


def _counted_runs(streams: DataFrame, run: int, per_batch: int, hosts: np.ndarray, keys: np.ndarray) -> DataFrame:
    """Runs of the hosts in a filter, if their keys are in another: (host, content, run), each once per stretch of a
    task's pages."""
    bits = streams.sparkSession.sparkContext.broadcast(hosts)
    shared = streams.sparkSession.sparkContext.broadcast(keys)

    def sort(batches):
        held, size = {}, 0

        def runs():
            for host, pages in held.items():
                content, found = _host_runs([p[0] for p in pages], np.array([p[1] for p in pages]), run)
                known = _held(shared.value, _keys(found, pages[0][2]))
                content, found = content[known], found[known]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([host] * found.size, pa.string()), pa.array(content), pa.array(found)], ["host", "content", "run"])
            held.clear()

        for batch in batches:
            for k in range(batch.num_rows):
                host, content, number, stream = (batch.column(c)[k].as_py() for c in range(4))
                if may_hold(bits.value, number):
                    tokens = np.frombuffer(stream, np.uint32)
                    held.setdefault(host, []).append((tokens, content, number))
                    size += tokens.size
                    if size >= per_batch:
                        yield from runs()
                        size = 0
        yield from runs()

    return streams.where(F.col("n_tokens") >= run).select("host", "content", F.xxhash64("host"), "stream").mapInArrow(
        sort, "host string, content long, run long")


def _own_runs(streams: DataFrame, run: int, per_batch: int, keys: np.ndarray) -> DataFrame:
    """Runs in a filter of every stream where they stand: (page_key, host, run, start)."""
    names = ["page_key", "host", "run", "start"]
    bits = streams.sparkSession.sparkContext.broadcast(keys)

    def cut(batches):
        for batch in batches:
            held, size = [], 0
            for k in range(batch.num_rows):
                key, host, number, stream = (batch.column(c)[k].as_py() for c in range(4))
                tokens = np.frombuffer(stream, np.uint32)
                found = _hashed_runs(tokens, np.arange(tokens.size - run + 1), run)
                starts = np.flatnonzero(_held(bits.value, _keys(found, number)))
                held.append((np.full(starts.size, key), np.full(starts.size, host, object), found[starts], starts))
                size += tokens.size
                if size >= per_batch:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names)
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names)

    return streams.where(F.col("n_tokens") >= run).select("page_key", "host", F.xxhash64("host"), "stream").mapInArrow(
        cut, "page_key long, host string, run long, start long")


def _keys(runs: np.ndarray, host: int) -> np.ndarray:
    """One number per run and host."""
    return mix(runs.view(np.uint64) ^ mix(np.array([host], np.int64).view(np.uint64))).view(np.int64)


def _held(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of many numbers a filter may hold."""
    low = keys & ((1 << FILTER_BITS) - 1)
    return (bits[low >> 5] >> (low & 31).astype(np.uint32) & 1).astype(bool)


def _shared_keys(streams: DataFrame, run: int, per_batch: int, hosts: np.ndarray) -> DataFrame:
    """Keys of runs that pages of two or more distinct contents of a host hold, among the hosts in a filter.

    Every task sends its runs as packed numbers, once per stretch of its pages, by ranges of their keys.
    """
    bits = streams.sparkSession.sparkContext.broadcast(hosts)
    tokens = streams.agg(F.sum("n_tokens")).first()[0] or 0
    ranges = 8 + int(tokens) // KEYS_PER_RANGE

    def send(batches):
        held, size = [], 0

        def packed():
            pairs = np.unique(np.concatenate(held, axis=1), axis=1) if held else np.empty((2, 0), np.int64)
            at = (pairs[0].view(np.uint64) % np.uint64(ranges)).astype(np.int64)
            order = np.argsort(at, kind="stable")
            ends = np.searchsorted(at[order], np.arange(ranges + 1))
            rows = [(r, *(p[order[a:b]].tobytes() for p in pairs)) for r, (a, b) in enumerate(zip(ends, ends[1:])) if b > a]
            held.clear()
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary()))], ["range", "keys", "contents"])

        for batch in batches:
            for content, number, stream in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if may_hold(bits.value, number):
                    found = np.frombuffer(stream, np.uint32)
                    keys = np.unique(_keys(_hashed_runs(found, np.arange(found.size - run + 1), run), number))
                    held.append(np.stack([keys, np.full(keys.size, content)]))
                    size += found.size
                    if size >= per_batch:
                        yield from packed()
                        size = 0
        yield from packed()

    def count(rows: pa.Table) -> pa.Table:
        keys, contents = (np.frombuffer(b"".join(rows[c].to_pylist()), np.int64) for c in ("keys", "contents"))
        pairs = np.unique(np.stack([keys, contents]), axis=1)
        return pa.table([pa.array(np.unique(pairs[0, 1:][pairs[0, 1:] == pairs[0, :-1]]))], ["number"])

    sent = streams.where(F.col("n_tokens") >= run).select("content", F.xxhash64("host"), "stream").mapInArrow(
        send, "range long, keys binary, contents binary")
    return sent.groupBy("range").applyInArrow(count, "number long")


def _several(content: str, least: int = CONTENTS) -> Column:
    """Whether a group has ``least`` (at most 64) or more distinct values of a 64-bit hash, as a combinable aggregate.

    Ten words take one bit each, chosen by six bits of the hash. Values of one word's bit are told apart
    by another; three that share bits in all ten words have a chance of about 1e-13.
    """
    words = [F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned({content}, {6 * k}) & 63 AS int))")) for k in range(10)]
    return F.greatest(*[F.bit_count(w) for w in words]) >= least


def repeated_runs(streams: DataFrame, undecided: Column, run: int = RUN_TOKENS, per_batch: int = SUFFIXES_PER_TASK) -> DataFrame:
    """Starts of token runs of undecided pages that pages of ``CONTENTS`` or more distinct contents of the host
    hold: (page_key, start).

    ``streams`` has (page_key, host, stream, n_tokens, content) and what ``undecided`` asks for. Runs of different
    suffix arrays are compared by 64-bit hashes. A run that a whole host has is one row per task; the look-up of a run that
    very many undecided pages have is split by the skewed join.
    """
    asking = streams.where(undecided)
    # hosts without an undecided page need no count; what the filter lets through by chance finds no page
    hosts = low_bits(asking.select(F.xxhash64("host").alias("number")), "number")
    keys = low_bits(staged(_shared_keys(streams, run, per_batch, hosts), "html-shared"), "number")
    repeated = _counted_runs(streams, run, per_batch, hosts, keys).groupBy("host", "run").agg(_several("content").alias("several"))
    repeated = repeated.where("several").select(F.col("host").alias("r_host"), F.col("run").alias("r_run"))
    own = _own_runs(asking, run, per_batch, keys)
    return own.join(repeated, (F.col("host") == F.col("r_host")) & (F.col("run") == F.col("r_run"))).select("page_key", "start")


def extract_text(pages: DataFrame, run: int = RUN_TOKENS) -> DataFrame:
    """Main text per page: (page_id, url, text, n_chars).

    Null html counts as empty; a page without main text has an empty text. White space inside a block
    becomes one space, blocks are joined by one space. Repeated rows are extracted each; pages of equal
    text count once where a host's repeated runs are sought; null urls form one host.
    """
    parsed = staged(_parsed(pages).drop("main"), "html-blocks")
    asking = F.col("blocks").isNotNull()
    runs = repeated_runs(parsed, asking, run)
    # positions within one page, bounded by its length
    covered = runs.groupBy(F.col("page_key").alias("r_key")).agg(F.collect_list("start").alias("starts"))
    open_pages = parsed.where(asking).select("page_key", "page_id", "url", "blocks").join(covered, F.col("page_key") == F.col("r_key"), "left").select(
        "page_id", "url", "blocks", "starts")

    def keep(batches):
        for batch in batches:
            texts = []
            for own, starts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = [w for b in own for w in b.encode().split()]
                gone = np.zeros(len(words) + run + 1, np.int32)
                for s in starts or []:
                    if s < len(words):
                        gone[s] += 1
                        gone[s + run] -= 1
                covered_words = np.cumsum(gone)[: len(words)] > 0
                texts.append(b" ".join(w for w, c in zip(words, covered_words) if not c).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    kept = open_pages.mapInArrow(keep, "page_id long, url string, text string")
    empty = parsed.where(~asking).select("page_id", "url", F.lit("").alias("text"))
    return empty.unionAll(kept).withColumn("n_chars", F.length("text").cast("long"))
