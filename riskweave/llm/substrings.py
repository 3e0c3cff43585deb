"""Removal of every byte covered by a long string that also stands elsewhere in the corpus.

Every window of ``LENGTH`` bytes has one anchor: its 64-byte gram of smallest hash (the first of equal
ones). Equal windows have equal anchors at the same place, so windows only need comparing with windows
of equal anchor grams. Anchors are some one in seventy positions; their hashes are dealt to buckets, and
an anchor seen once is done with.

An anchor with more windows than a bucket takes (a line that very many texts hold, each with other text
around it) goes apart: its distinct contents are cut into windows, and windows of equal digest are counted,
combined in every task, so that no group grows with the number of texts.

What is left is suffix sorting. The suffixes of a bucket are its windows' starts. They are sorted
deep-shallow: a multikey sort on eight-byte characters to a shallow depth, then, for the groups that
still share their prefix, blind tries: a group is only sorted at the characters where its members branch,
all characters in between are skipped by comparing with the group's first member. Groups that hold
together to the full length are the repeated strings.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import lean, lean_group, low_bits, may_hold, text_chunks, utf8
from riskweave.llm.shingles import mix, powers
from riskweave.session import staged

LENGTH = 200
GRAM = 64
#: Depth of the multikey sort, and bytes of one character of it.
SHALLOW, CHARACTER = 24, 8
#: A longer text is scanned in overlapping pieces of this many bytes.
PIECE = 1 << 22
#: Anchors and windows of a bucket.
BUCKET_ANCHORS, BUCKET_WINDOWS = 250_000, 400_000

_POSITION = np.uint64((1 << 24) - 1)
_VALUE = np.random.default_rng(8).integers(1, 2**63, 256, dtype=np.uint64)


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive keys, by running minima within blocks from both sides."""
    n = keys.size
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    block = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(block, axis=1).reshape(-1)
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchored(texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """Windows of texts by anchor: (text, first window, windows, anchor hash), one entry per anchor."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    none = np.empty(0, np.int64)
    if data.size < length:
        return none, none, none, np.empty(0, np.uint64)
    up, down = powers(1 << max(21, int(data.size).bit_length()))
    total = np.zeros(data.size + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[: data.size], out=total[1:])
    grams = mix((total[gram:] - total[:-gram]) * down[: data.size - gram + 1])
    # a hash and the place, so that of equal hashes the first is the least
    keys = (grams & ~_POSITION) | np.arange(grams.size, dtype=np.uint64)
    place = (_sliding_least(keys, length - gram + 1) & _POSITION).astype(np.int64)
    ends = np.cumsum([len(t) for t in texts])
    begins = ends - [len(t) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [max(0, len(t) - length + 1) for t in texts])
    counts = np.bincount(owner, minlength=len(texts))
    window = np.arange(owner.size) - np.repeat(np.cumsum(counts) - counts, counts) + begins[owner]
    if not window.size:
        return none, none, none, np.empty(0, np.uint64)
    place = place[window]
    new = np.ones(window.size, bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, window.size))
    return owner[first], window[first] - begins[owner[first]], sizes, grams[place[first]]


def repeated_windows(data: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which of the suffixes starting at ``starts`` agree with another one over ``length`` bytes.

    Sorts deep-shallow. ``data`` must reach ``length`` bytes beyond every start.
    """
    view = np.lib.stride_tricks.as_strided(data[: data.size - CHARACTER + 1].view(), (data.size - CHARACTER + 1, CHARACTER), (1, 1))

    def character(rows: np.ndarray, depth: int) -> np.ndarray:
        width = min(CHARACTER, length - depth)
        own = np.zeros((rows.size, CHARACTER), np.uint8)
        own[:, :width] = view[starts[rows] + depth + width - CHARACTER, CHARACTER - width :] if width < CHARACTER else view[starts[rows] + depth]
        return own.view(">u8").reshape(-1).astype(np.uint64)

    rows, group = np.arange(starts.size), np.zeros(starts.size, np.int64)
    for depth in range(0, length, CHARACTER):
        if not rows.size:
            break
        own = character(rows, depth)
        if depth >= SHALLOW:  # blind tries: skip characters at which a group does not branch
            first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            size = np.diff(np.append(first, rows.size))
            branches = np.logical_or.reduceat(own != np.repeat(own[first], size), first)
            moved = np.repeat(branches, size)
            if not moved.any():
                continue
            part, key, old = rows[moved], own[moved], group[moved]
            order = np.lexsort((key, old))
            rows[moved], own[moved] = part[order], key[order]
        else:  # multikey sort within groups
            order = np.lexsort((own, group))
            rows, own, group = rows[order], own[order], group[order]
        new = np.append(True, (group[1:] != group[:-1]) | (own[1:] != own[:-1]))
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, rows.size))
        many = np.repeat(size > 1, size)
        group = np.repeat(np.arange(first.size), size)[many]
        rows = rows[many]
    found = np.zeros(starts.size, bool)
    found[rows] = True
    return found


def _text_key(text: Column) -> list[Column]:
    """120 bits of a text's md5 as two numbers."""
    return [F.conv(F.substring(F.md5(text), at, 15), 16, 10).cast("long").alias(name) for at, name in ((1, "k1"), (16, "k2"))]


def _packed(values: dict[str, np.ndarray], bucket: np.ndarray) -> pa.RecordBatch:
    """A row per bucket that holds the bytes of its entries' columns."""
    order = np.argsort(bucket, kind="stable")
    names, first = np.unique(bucket[order], return_index=True)
    ends = np.append(first[1:], bucket.size)
    columns = [pa.array(names.astype(np.int64))]
    columns += [pa.array([v[order][a:b].tobytes() for a, b in zip(first, ends)], pa.binary()) for v in values.values()]
    return pa.RecordBatch.from_arrays(columns, ["bucket", *values])


def _pieces(batch: pa.RecordBatch, length: int):
    """Rounds of (texts, keys, offsets), each distinct text once; a long text comes in overlapping pieces."""
    seen = set()
    for first, texts in text_chunks(batch.column(2)):
        keys = list(zip(batch.column(0).slice(first, len(texts)).to_pylist(), batch.column(1).slice(first, len(texts)).to_pylist()))
        own = []
        for key, text in zip(keys, texts):
            if key not in seen and len(text) >= length:
                seen.add(key)
                own.append((text, key))
        if len(own) == 1 and len(own[0][0]) > PIECE:
            text, key = own[0]
            for at in range(0, len(text) - length + 1, PIECE):
                yield [text[at : at + PIECE + length - 1]], [key], [at]
        elif own:
            yield [t for t, _ in own], [k for _, k in own], [0] * len(own)


def _shared_anchors(texts: DataFrame, total: int, length: int, gram: int) -> DataFrame:
    """Anchors whose hash two or more windows' runs have: (k1, k2, anchor, start, windows)."""
    buckets = total // 70 // BUCKET_ANCHORS + 1
    schema = "bucket long, anchor binary, k1 binary, k2 binary, start binary, windows binary"

    def deal(batches):
        for batch in batches:
            found = []
            for part, keys, offsets in _pieces(batch, length):
                owner, start, windows, anchor = anchored(part, length, gram)
                key = np.array(keys, np.int64).reshape(-1, 2)[owner]
                found.append((anchor, key[:, 0], key[:, 1], start + np.array(offsets)[owner], windows.astype(np.int32)))
            if found:
                anchor, k1, k2, start, windows = (np.concatenate(c) for c in zip(*found))
                yield _packed({"anchor": anchor, "k1": k1, "k2": k2, "start": start, "windows": windows},
                              ((anchor >> np.uint64(8)) % np.uint64(buckets)).astype(np.int64))

    def meet(g: pd.DataFrame) -> pd.DataFrame:
        anchor = np.frombuffer(b"".join(g["anchor"]), np.uint64)
        k1, k2, start = (np.frombuffer(b"".join(g[c]), np.int64) for c in ("k1", "k2", "start"))
        windows = np.frombuffer(b"".join(g["windows"]), np.int32)
        order = np.lexsort((start, k2, k1, anchor))
        anchor, k1, k2, start, windows = (x[order] for x in (anchor, k1, k2, start, windows))
        same = np.append(False, (anchor[1:] == anchor[:-1]) & (k1[1:] == k1[:-1]) & (k2[1:] == k2[:-1]) & (start[1:] == start[:-1]))
        anchor, k1, k2, start, windows = (x[~same] for x in (anchor, k1, k2, start, windows))
        near = anchor[1:] == anchor[:-1]
        many = np.append(near, False) | np.append(False, near)
        return pd.DataFrame({"k1": k1[many], "k2": k2[many], "anchor": anchor[many].view(np.int64), "start": start[many],
                             "windows": windows[many].astype(np.int64)})

    return texts.mapInArrow(lean(deal), schema).groupBy("bucket").applyInPandas(
        lean_group(meet), "k1 long, k2 long, anchor long, start long, windows long")


def _heavy_anchors(anchors: DataFrame) -> set[int]:
    """Anchors with more windows than a bucket takes; at most the number of buckets."""
    sums = anchors.groupBy("anchor").agg(F.sum("windows").alias("n")).where(F.col("n") > BUCKET_WINDOWS)
    return {r["anchor"] for r in sums.collect()}


def _repeated_of_heavy(candidates: DataFrame, heavy: set[int], length: int) -> DataFrame:
    """Runs as of ``_repeated``, for the anchors in ``heavy``: windows of equal 128-bit digest are the same."""
    wanted = candidates.sparkSession.sparkContext.broadcast(heavy)
    key, window = "c1 long, c2 long", "w1 long, w2 long"

    def digest(part: bytes) -> bytes:
        return hashlib.blake2b(part, digest_size=16).digest()

    def places(batches):
        for batch in batches:
            seen, rows, keys = set(), [], []
            for k1, k2, text, anchors in zip(
                    batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), batch.column(3).to_pylist()):
                for a in anchors:
                    if a["anchor"] in wanted.value:
                        content = text[a["start"] : a["start"] + a["windows"] + length - 1]
                        keys.append(digest(content))
                        rows.append((k1, k2, a["start"], None if keys[-1] in seen else content))
                        seen.add(keys[-1])
            if rows:
                c = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
                k1, k2, start, content = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[:, 0]), pa.array(c[:, 1]), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                     pa.array(start, pa.int64()), pa.array(content, pa.binary())], ["c1", "c2", "k1", "k2", "start", "content"])

    def cut(bits):
        def run(batches):
            for batch in batches:
                c1, c2, copies = (batch.column(k).to_numpy() for k in (0, 1, 3))
                for k, content in enumerate(batch.column(2).to_pylist()):
                    n = len(content) - length + 1
                    w = np.frombuffer(b"".join(digest(content[o : o + length]) for o in range(n)), np.int64).reshape(-1, 2)
                    at = np.arange(n)
                    if bits is not None:
                        at = at[[may_hold(bits.value, x) for x in w[:, 0].tolist()]]
                    columns = (np.full(at.size, c1[k]), np.full(at.size, c2[k]), w[at, 0], w[at, 1], at, np.full(at.size, copies[k]))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["c1", "c2", "w1", "w2", "at", "copies"])
        return run

    def join_up(batches):
        for batch in batches:
            firsts, lasts = [], []
            for offsets in batch.column(2).to_pylist():
                at = np.sort(np.array(offsets, np.int64))
                new = np.append(True, np.diff(at) > 1)
                firsts.append(at[new].tolist())
                lasts.append(at[np.append(new[1:], True)].tolist())
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(firsts, longs), pa.array(lasts, longs)], ["d1", "d2", "firsts", "lasts"])

    held = staged(candidates.mapInArrow(places, f"{key}, k1 long, k2 long, start long, content binary"), "dedup-heavy")
    contents = staged(held.groupBy("c1", "c2").agg(F.max("content").alias("content"), F.count("*").alias("copies")), "dedup-contents")
    schema = f"{key}, {window}, at long, copies long"
    many = staged(
        contents.mapInArrow(lean(cut(None)), schema).groupBy("w1", "w2").agg(F.sum("copies").alias("n")).where("n > 1")
        .select(F.col("w1").alias("m1"), F.col("w2").alias("m2")), "dedup-windows")
    bits = candidates.sparkSession.sparkContext.broadcast(low_bits(many, "m1"))
    again = contents.mapInArrow(lean(cut(bits)), schema).join(many, (F.col("w1") == F.col("m1")) & (F.col("w2") == F.col("m2")))
    runs = again.groupBy("c1", "c2").agg(F.collect_list("at").alias("at")).mapInArrow(
        join_up, "d1 long, d2 long, firsts array<long>, lasts array<long>")
    return held.join(runs, (F.col("c1") == F.col("d1")) & (F.col("c2") == F.col("d2"))).select(
        "k1", "k2", "start", F.explode(F.arrays_zip("firsts", "lasts")).alias("run")).select(
        "k1", "k2", (F.col("start") + F.col("run.firsts")).alias("first"), (F.col("start") + F.col("run.lasts")).alias("last"))


def _repeated(candidates: DataFrame, windows: int, length: int, heavy: set[int]) -> DataFrame:
    """Runs of window starts that are repeated: (k1, k2, first, last), but for the anchors in ``heavy``.

    The bytes of an anchor's windows travel once per task and content, with the list of places that have
    them, so a passage that very many documents share costs little more than its places.
    """
    buckets = windows // BUCKET_WINDOWS + 1
    apart = candidates.sparkSession.sparkContext.broadcast(heavy)
    schema = "bucket long, anchor long, windows int, content binary, places binary"

    def deal(batches):
        for batch in batches:
            held: dict[tuple, list[int]] = {}
            for k1, k2, text, anchors in zip(
                    batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), batch.column(3).to_pylist()):
                for a in anchors:
                    if a["anchor"] in apart.value:
                        continue
                    content = text[a["start"] : a["start"] + a["windows"] + length - 1]
                    held.setdefault((a["anchor"], a["windows"], content), []).extend((k1, k2, a["start"]))
            if held:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] % buckets for k in held], pa.int64()), pa.array([k[0] for k in held], pa.int64()),
                     pa.array([k[1] for k in held], pa.int32()), pa.array([k[2] for k in held], pa.binary()),
                     pa.array([np.array(p, np.int64).tobytes() for p in held.values()], pa.binary())],
                    ["bucket", "anchor", "windows", "content", "places"])

    def sort(g: pd.DataFrame) -> pd.DataFrame:
        # equal contents of several tasks are one; their windows are repeated as soon as they have two places
        merged: dict[tuple, list[bytes]] = {}
        for anchor, content, places in zip(g["anchor"], g["content"], g["places"]):
            merged.setdefault((anchor, content), []).append(places)
        contents = [c for _, c in merged]
        places = [np.frombuffer(b"".join(p), np.int64).reshape(-1, 3) for p in merged.values()]
        sizes = np.array([len(c) for c in contents])
        begins = np.cumsum(sizes) - sizes
        counts = sizes - length + 1
        owner = np.repeat(np.arange(sizes.size), counts)
        offset = np.arange(owner.size) - np.repeat(np.cumsum(counts) - counts, counts)
        data = np.frombuffer(b"".join(contents), np.uint8)
        found = repeated_windows(data, begins[owner] + offset, length)
        found |= np.array([len(p) > 1 for p in places])[owner]
        edge = np.diff(np.concatenate([[0], found.astype(np.int8), [0]]))
        # runs end with their content
        cut = np.append(True, owner[1:] != owner[:-1])
        new = np.flatnonzero(found & ((edge[:-1] == 1) | cut))
        last = np.flatnonzero(found & ((edge[1:] == -1) | np.append(cut[1:], True)))
        out = []
        for a, b in zip(new.tolist(), last.tolist()):
            p = places[owner[a]]
            out.append(np.column_stack([p[:, :2], p[:, 2] + offset[a], p[:, 2] + offset[b]]))
        rows = np.concatenate(out) if out else np.empty((0, 4), np.int64)
        return pd.DataFrame(rows, columns=["k1", "k2", "first", "last"])

    return candidates.mapInArrow(lean(deal), schema).groupBy("bucket").applyInPandas(lean_group(sort), "k1 long, k2 long, first long, last long")


def kept_bytes(text: bytes, firsts: list[int], lasts: list[int], length: int = LENGTH) -> tuple[bytes, int]:
    """Text without the windows that start from first to last, and the number of maximal removed runs."""
    gone = np.zeros(len(text) + 1, np.int32)
    np.add.at(gone, firsts, 1)
    np.add.at(gone, np.asarray(lasts) + length, -1)
    covered = np.cumsum(gone)[:-1] > 0
    spans = int(np.count_nonzero(np.diff(np.concatenate([[0], covered.astype(np.int8)])) == 1))
    return np.frombuffer(text, np.uint8)[~covered].tobytes(), spans


def repeated_spans(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Distinct texts with repeated windows (k1, k2, text, runs), and texts that occur whole more than
    once (k1, k2, copies); runs are (first, last) starts of windows."""
    texts = documents.select(*_text_key(F.col("text")), "text").where(F.octet_length("text") >= length)
    totals = texts.groupBy("k1", "k2").agg(F.count("*").alias("copies"), F.first(F.octet_length("text")).alias("size"))
    totals = staged(totals, "dedup-texts")
    total = totals.agg(F.sum("size")).first()[0] or 0
    anchors = staged(_shared_anchors(texts, total, length, gram), "dedup-anchors")
    windows = anchors.agg(F.sum("windows")).first()[0] or 0

    bits = documents.sparkSession.sparkContext.broadcast(low_bits(anchors, "k1"))

    def wanted(batches):
        for batch in batches:
            seen, keep = set(), []
            for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keep.append(key not in seen and may_hold(bits.value, key[0]))
                seen.add(key)
            yield batch.filter(pa.array(keep, pa.bool_()))

    per_text = anchors.groupBy("k1", "k2").agg(F.collect_list(F.struct("anchor", "start", "windows")).alias("anchors"))
    sent = texts.mapInArrow(lean(wanted), "k1 long, k2 long, text string").groupBy("k1", "k2").agg(F.first("text").alias("text"))
    candidates = staged(sent.join(per_text, ["k1", "k2"]), "dedup-candidates")
    heavy, dealt = _heavy_anchors(anchors), candidates.select("k1", "k2", "text", "anchors")
    runs = _repeated(dealt, windows, length, heavy)
    if heavy:
        runs = runs.unionAll(_repeated_of_heavy(dealt, heavy, length))
    runs = runs.groupBy("k1", "k2").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    return candidates.select("k1", "k2", "text").join(runs, ["k1", "k2"]), totals.where("copies > 1").select("k1", "k2", "copies")


def _cut(spans: DataFrame, length: int) -> DataFrame:
    """(k1, k2, n_left, n_spans, sha, kept) of texts with repeated windows."""
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["k1", "k2", "n_left", "n_spans", "sha", "kept"]

    def cut(batches):
        for batch in batches:
            rows = []
            for k1, k2, text, runs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), batch.column(3).to_pylist()):
                left, n = kept_bytes(text, [r["first"] for r in runs], [r["last"] for r in runs], length)
                rows.append((k1, k2, len(left), n, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore")))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, types)], names)

    return spans.select("k1", "k2", "text", "runs").mapInArrow(
        lean(cut), "k1 long, k2 long, n_left long, n_spans long, sha string, kept string")


def remove_repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Documents, all columns, with ``kept_text``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` (which
    replace columns of these names).

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else in any document,
    the same included; all is judged on the input, so of a repeated string every occurrence goes. Texts
    are UTF-8 bytes; null counts as empty; strings do not cross documents; shorter texts stay whole.
    ``kept_text`` leaves out bytes of characters that were cut apart, the digest is of all kept bytes.
    Ids play no part: null and repeated ids are kept as they come, repeated rows are copies.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    spans, copies = repeated_spans(documents.select(text.alias("text")), length, gram)
    cut = staged(_cut(spans, length), "dedup-cut")
    k1, k2 = _text_key(text)
    docs = documents.withColumns({"_k1": k1, "_k2": k2})
    cut = cut.select(*[F.col(c).alias(f"_{c}") for c in cut.columns]).withColumnsRenamed({"_k1": "_c1", "_k2": "_c2"})
    copies = copies.select(F.col("k1").alias("_d1"), F.col("k2").alias("_d2"), F.col("copies").alias("_copies"))
    joined = docs.join(cut, (F.col("_k1") == F.col("_c1")) & (F.col("_k2") == F.col("_c2")), "left").join(
        copies, (F.col("_k1") == F.col("_d1")) & (F.col("_k2") == F.col("_d2")), "left")
    size = F.octet_length(text).cast("long")
    whole, some = F.col("_copies").isNotNull(), F.col("_n_left").isNotNull()
    return joined.withColumns({
        "kept_text": F.when(whole, "").when(some, F.col("_kept")).otherwise(text),
        "n_bytes": size,
        "n_removed": F.when(whole, size).when(some, size - F.col("_n_left")).otherwise(0).cast("long"),
        "n_spans": F.when(whole, 1).when(some, F.col("_n_spans")).otherwise(0).cast("long"),
        "kept_sha256": F.when(whole, F.sha2(F.lit(""), 256)).when(some, F.col("_sha")).otherwise(F.sha2(text, 256)),
    }).drop("_k1", "_k2", "_c1", "_c2", "_d1", "_d2", "_copies", "_n_left", "_n_spans", "_sha", "_kept")


def without_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """Documents, same columns, with repeated strings cut from ``text`` and ``n_chars`` counted anew.

    A document that consists of repeated strings alone is dropped; one that came empty stays. Other columns
    pass unchanged, whatever their names.
    """
    others = [c for c in documents.columns if c != "text"]
    rest = F.struct(*others) if others else F.lit(None)
    kept = remove_repeats(documents.select(rest.alias("rest"), "text"), length)
    changed = F.col("n_removed") > 0
    old = lambda f: F.col("text") if f.name == "text" else F.col("rest")[f.name]
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text")}
    return kept.where(~changed | (F.length("kept_text") > 0)).select(*[
        (F.when(changed, new[f.name].cast(f.dataType)).otherwise(old(f)) if f.name in new else old(f)).alias(f.name)
        for f in documents.schema])
