"""Operators against brute force on small tables with nulls, empty and long texts, ties and repeats."""

import gzip
import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskweave.llm import (
    components, decontaminate, html_text, licenses, mixing, ngram_join, shingles, sql, substrings, tokens, toxicity, vantage, warc,
)
from riskweave.session import staged

DOC = "doc_id long, text string, lang string, source string, n_chars long, size long, node long, row_key string"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = [prose(rng, rng.randint(1, 200)) for _ in range(60)]
    passage = prose(rng, 70)
    out = [None, "", "  \n", "one two", "One TWO", "é ü  x", *base, base[0], base[0], *base[3:6]]
    for b in base[:25]:  # near copies of several degrees
        words = b.split()
        for _ in range(3):
            copy = list(words)
            for _ in range(rng.randint(1, 4)):
                copy[rng.randrange(len(copy))] = prose(rng, 1)
            out.append(" ".join(copy))
    family = prose(rng, 120).split()
    for _ in range(90):  # a group too large for one leaf, its members often further apart than the threshold
        copy = list(family)
        for k in range(rng.randint(1, 5)):
            copy[rng.randrange(120)] = prose(rng, 1)
        out.append(" ".join(copy))
    out += [prose(rng, 20) + " " + passage + " " + prose(rng, 30) for _ in range(8)]
    out += [prose(rng, 30_000), "x" * 5000, "x" * 5000 + "y", "ab " * 2000]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(None if i % 41 == 7 else i, t, "en", [None, "b", "a", "a", "a"][i % 5], 0, -1, -1, "k") for i, t in enumerate(texts)]
    rows += [rows[10], rows[10]]
    return spark.createDataFrame(rows, DOC).repartition(3)


def collected(df):
    return sorted(df.collect(), key=repr)


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def shingle_set(text, n=5):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def test_ngram_groups_equal_brute_force(docs):
    rows = [(r.doc_id, shingle_set(r.text)) for r in docs.collect()]
    label = list(range(len(rows)))
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            b = rows[j][1]
            shared = len(a & b)
            if a and b and 100 * shared >= 75 * (len(a) + len(b) - shared):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = defaultdict(list)
    for (doc, _), x in zip(rows, label):
        if doc is not None:
            least[x].append(doc)
    want = Counter((doc, len(s), min(least[x], default=None)) for (doc, s), x in zip(rows, label))
    assert Counter(map(tuple, ngram_join.linked_groups(docs).collect())) == want


def test_count_tree_bound_loses_nothing():
    rng = np.random.default_rng(1)
    sets = [frozenset(rng.choice(400, rng.integers(20, 60), replace=False).tolist()) for _ in range(300)]
    sets += [frozenset(list(s)[2:]) for s in sets[:100]]
    points = np.array([np.bincount([x % 16 for x in s], minlength=16) for s in sets], np.uint32)
    sizes = np.array([len(s) for s in sets])
    tree = ngram_join.CountTree(points, sizes)
    for k, s in enumerate(sets):
        found = set(tree.search(points[k], sizes[k], 75).tolist())
        assert {j for j, t in enumerate(sets) if 100 * len(s & t) >= 75 * len(s | t)} <= found


def test_one_per_group_keeps_one(docs, spark):
    kept = ngram_join.one_per_group(docs)
    assert kept.columns == docs.columns
    groups = ngram_join.linked_groups(kept).where("n_shingles > 0 AND doc_id IS NOT NULL")
    assert groups.where("doc_id <> component_id").count() == 0
    assert ngram_join.linked_groups(empty(spark, DOC)).collect() == []


def test_join_sends_small_sketches_and_keys(spark, monkeypatch):
    rng = random.Random(3)
    texts = [prose(rng, 60) for _ in range(300)]
    docs = spark.createDataFrame([(k, t, None) for k, t in enumerate(texts)], "doc_id long, text string, row_key string").coalesce(2)
    bits = 16
    pieces = ngram_join._nodes(docs, bits).where("piece IS NOT NULL").select("piece", "counts").collect()
    # sent whole, the sketches of all tasks grow with the tasks times the entries
    assert sum(len(r["counts"]) for r in pieces) < 2 * 2 * (1 << bits) / 4
    total = np.zeros((1 << bits) >> ngram_join.PIECE_BITS << ngram_join.PIECE_BITS, np.int64).reshape(-1, 1 << ngram_join.PIECE_BITS)
    for r in pieces:
        total[r["piece"]] += ngram_join._unpacked(r["counts"])
    want = np.zeros(1 << bits, np.int64)
    for own in shingles.shingle_sets([t.encode() for t in texts]):
        want[(own & np.uint64((1 << bits) - 1)).astype(int)] += 1
    assert (total.reshape(-1) == want).all()
    for counts in (np.array([0, 255, 3], np.uint16), np.array([65535, 0, 256], np.uint16)):
        assert (ngram_join._unpacked(ngram_join._packed(counts)) == counts).all()

    # keys that agree in the bits that are sent only add candidates
    copies = [(k, texts[k % 40] + (" more" if k >= 40 else ""), "en") for k in range(80)]
    table = spark.createDataFrame(copies, "doc_id long, text string, lang string")
    want = sorted((k, k % 40) for k in range(80))
    for shift in (ngram_join.KEY_SHIFT, 54):
        monkeypatch.setattr(ngram_join, "KEY_SHIFT", shift)
        assert sorted((r["doc_id"], r["component_id"]) for r in ngram_join.linked_groups(table).collect()) == want


def test_join_writes_no_shingle_sets_between_shuffles(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(ngram_join, "staged", lambda df, label: (kept.append(label), staged(df, label))[1])
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, text), (2, text + " eleven"), (3, "others " + text[4:])], "doc_id long, text string")
    assert len(ngram_join.linked_groups(docs).collect()) == 3
    assert "join-links" in kept and "join-sets" not in kept


def test_merged_components(spark):
    rng = random.Random(11)
    first = [(rng.randrange(300), rng.randrange(300)) for _ in range(120)] + [(500, k) for k in range(501, 560)]
    more = [(rng.randrange(320), rng.randrange(320)) for _ in range(60)] + [(7, 559), (600, 601), (520, 530)]
    frame = lambda edges: spark.createDataFrame(edges, "a long, b long").repartition(4)
    groups = components.components(frame(first))
    want = dict(map(tuple, components.components(frame(first + more)).collect()))
    got = components.merged(groups, frame(more)).collect()
    assert len(got) == len(want) and dict(map(tuple, got)) == want
    assert components.merged(groups, frame([(1, 1)]).where("a <> b")).count() == groups.count()
    none = frame([(1, 2)]).where("a > b")
    assert components.components(none).count() == 0


def test_large_blocks_list_every_pair(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SEARCH_NODES", 20)
    monkeypatch.setattr(ngram_join, "NAMED_BLOCKS", 3)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    sets = [np.unique(np.where(rng.random(60) < 0.1, rng.integers(0, 1 << 63, 60, dtype=np.uint64), base)) for _ in range(70)]
    points = spark.createDataFrame([(k, int(s.size), ngram_join._point(s)) for k, s in enumerate(sets)], "node long, n long, point binary")
    blocks = {b: [k for k in range(70) if rng.random() < 0.8] for b in rng.integers(-(1 << 62), 1 << 62, 6).tolist()}
    rows = [(b, k, k % 9, len(own)) for b, own in blocks.items() for k in own]
    got = ngram_join._search_large(spark.createDataFrame(rows, "block long, node long, group long, members long"), points, 75).collect()
    full = ngram_join._points([ngram_join._point(s) for s in sets], ngram_join.GROUPS).astype(int)
    want = {(a, b) for own in blocks.values() for a in own for b in own if a < b and a % 9 != b % 9
            and np.minimum(full[a], full[b]).sum() >= ngram_join.overlap_needed(sets[a].size, sets[b].size)}
    assert want and set(map(tuple, got)) == want
    assert len(got) < 1.5 * len(want)


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 11), (12, 11), (5, 5), *[(100 + i, 101 + i) for i in range(40)]]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()))
    assert got == {1: 1, 2: 1, 3: 1, 10: 10, 11: 10, 12: 10, **{100 + i: 100 for i in range(41)}}


def oracle(name, **tables):
    con = duckdb.connect()
    for key, df in tables.items():
        con.register(key, df.toArrow())
    return con.execute(sql.ORACLE_SQL[name]).fetchall()


def test_mix_equals_sql(docs, spark):
    got = mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")
    rounded = lambda rows: sorted(((a, b, c, round(float(d), 6), e) for a, b, c, d, e in rows), key=repr)
    assert rounded(got.collect()) == rounded(oracle("op2_source_mix", documents=docs))
    assert mixing.mix(empty(spark, DOC)).collect() == []


def test_mix_meets_targets(spark):
    rows = [(i, "w " * (1 + i % 7), f"s{min(i % 9, 4)}") for i in range(4000)]
    by = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).groupBy("source_size", "target").agg(
        F.sum("taken").alias("taken"), F.max(F.col("taken") - 2 * F.col("size")).alias("over")).collect()
    assert all(abs(r.taken - r.target) <= 7 and r.over <= 0 for r in by)


def test_contained_items_equal_brute_force(docs, spark):
    held = [r.text for r in docs.where("length(text) > 300").orderBy("doc_id").limit(12).collect()]
    items = [(i, " ".join(t.split()[5:40])) for i, t in enumerate(held)]
    items += [(100, "one two"), (101, None), (102, ""), (103, "nowhere to be found at all"), (104, items[0][1] + " tail words end"), (105, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for r in docs.collect():
        for i, t in items:
            s = shingle_set(t)
            n = min(5, len((t or "").split()))
            w = (r.text or "").encode().lower().split()
            own = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()
            if s and len(s & own) >= 0.75 * len(s):
                want.append((r.doc_id, i, len(s), len(s & own), len(s & own) / len(s)))
    for size in (decontaminate.SLICE_SHINGLES, 40):
        got = decontaminate.contaminated(docs, bench, slice_shingles=size)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert decontaminate.contaminated(docs, empty(spark, "item_id long, text string")).collect() == []


def test_archives_round_trip(spark, tmp_path):
    rows = [(5, "http://a/x", "<p>é</p>"), (2, "http://a/y\r\nX: 1", "<p>é</p>"), (3, None, None), (4, "http://b", ""), (None, "http://c", "a\r\n\r\nWARC/1.1\r\n\r\n"),
            (9, "http://d", "z" * 3_000_000), (8, "http://d", "z" * 3_000_000), (2, "http://e", "other")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(pages.coalesce(1), str(tmp_path / "w"), archive_bytes=200)
    records = warc.with_originals(warc.read_archives(spark, str(tmp_path / "w"), with_payload=True))
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records.collect()), key=repr)
    assert got == sorted(oracle("op5_warc_revisits", pages=pages), key=repr)
    payloads = {r.page_id: bytes(r.payload) for r in records.where("record_type = 'response'").collect()}
    assert payloads[8] == b"z" * 3_000_000 and payloads[None] == rows[4][2].encode()
    archives = [p.read_bytes() for p in (tmp_path / "w").glob("part-*")]
    assert len(archives) > 2 and max(map(len, archives)) < 5000  # closed by their bytes
    revisits = 0
    for archive in archives:
        members, rest = [], archive
        while rest:
            inflate = zlib.decompressobj(31)
            members.append(inflate.decompress(rest))
            rest = inflate.unused_data
        assert members[0].startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and members[-1] == b""
        for m in members[1:-1]:  # a record a member
            length = int(re.search(rb"\r\nContent-Length: (\d+)\r\n\r\n", m)[1])
            assert m.startswith(b"WARC/1.1\r\n") and m.endswith(b"\r\n\r\n") and len(m.split(b"\r\n\r\n", 1)[1]) == length + 4
            revisits += b"WARC-Refers-To-Target-URI: http" in m and b"WARC-Refers-To-Date: 20" in m
    assert revisits == 2


def test_archives_of_no_pages_and_of_equal_pages(spark, tmp_path):
    warc.write_archives(empty(spark, "page_id long, url string, html string"), str(tmp_path / "none"))
    assert warc.with_originals(warc.read_archives(spark, str(tmp_path / "none"))).collect() == []
    pages = spark.range(3000).selectExpr("id AS page_id", "'u' AS url", "if(id % 3 = 0, repeat('same', 99), concat('page ', id div 2)) AS html",
                                         "1 AS digest", "2 AS kept_by", "'x' AS first_id", "4 AS size")
    warc.write_archives(pages, str(tmp_path / "many"), min_bytes=8)
    got = warc.with_originals(warc.read_archives(spark, str(tmp_path / "many"), with_payload=True)).collect()
    kept, want = {}, set()
    for r in pages.orderBy("page_id").collect():
        first = kept.setdefault(r.html, r.page_id) if len(r.html) >= 8 else r.page_id
        want.add((r.page_id, "response" if first == r.page_id else "revisit", None if first == r.page_id else first))
    refers = {(r.page_id, r.record_type, r.refers_to if r.record_type == "revisit" else None) for r in got}
    assert len(got) == 3000 and refers == want
    texts = dict(pages.select("page_id", "html").collect())
    assert all(bytes(r.payload).decode() == texts[r.page_id] for r in got if r.record_type == "response")


def test_archives_inflate_in_linear_time():
    members = [gzip.compress(f"record {k} {random.Random(k).random()}".encode(), mtime=0) for k in range(20_000)] + [gzip.compress(bytes(50_000_000), mtime=0)]
    stream, began = warc._Inflated(b"".join(members)), time.monotonic()
    size = 0
    while stream._more():
        stream.at = len(stream.buffer)
        size += stream.at
    assert size > 50_000_000 and time.monotonic() - began < 10


def test_blocks_of_pages():
    page = (
        '<html><head><title>x</title></head><body class="has-sidebar"><header>Site</header><nav><ul><li>Menu<li>b</ul></nav>'
        '<div class="cookie-notice">We use cookies</div><article><h1>T&eacute;st &amp; more</h1><p>One <b>bo</b>ld   text<p>two<br>lines'
        '<div class="ad">buy</div><script>var a="</p>";</script><section id="comments"><p>bad</section><form>q</form><p>a &lt; b < c</article>'
        "<aside>side</aside><footer>f</footer>")
    assert " ".join(t for kind, t in html_text.blocks(page) if kind == html_text.ARTICLE) == "Tést & more One bold text two lines a < b < c"


@pytest.mark.parametrize("page", [
    '<div class="content has-sidebar"><article>A b<p>c</article></div>',
    '<div class="layout-sidebar-left"><div><main>A b<p>c</main></div></div>',
    '<article class="post no-comments">A b<p>c</article>',
    '<div class="with-banner"><article>A b<p>c</article></div>',
    '<div id="search-results"><article>A b<p>c</article></div>',
    '<div class="widget-area"><article>A b<p>c</article></div>',
    '<div class="sidebar"><p>bad</p><article>A b<p>c</article>bad</div>',
    '<form id="aspnet"><p>bad</p><article class="sidebar">A b<p>c</article></form>',
    '<div class="header"><div role="main">A b<p>c</div></div>',
    '<article><div class="entry-header"><h1>A</h1> <span>b</span></div><p>c</article>',
    '<article><div class="article-header">A b</div><p>c</article>',
    '<article><header class="header">A b</header><p>c</article>',
    '<article><div class="header">A b</div><p>c<div class="share-buttons">bad</div></article>',
    '<article>A b<p>c<div class="sidebar"><article>bad</article></div></article>',
    '<main>A b<p>c<section class="comments-area"><article>bad</article></section><article class="comment">bad</article></main>',
    '<article>A b<p>c</article><nav><article>bad</article></nav><aside><main>bad</main></aside>',
    '<article>A b<p>c</article><div id="comments"><article>bad</article></div><div role="complementary"><article>bad</article></div>',
])
def test_names_of_elements_around_articles(page):
    found = html_text.blocks(f"<body>{page}</body>")
    assert " ".join(t for kind, t in found if kind == html_text.ARTICLE) == "A b c"


def test_names_that_mark_a_page_set_nothing_aside():
    for name in ("content has-sidebar", "layout-sidebar-left", "with-banner", "search-results", "widget-area", "no-comments"):
        assert html_text.blocks(f'<div class="{name}">text</div>') == [(html_text.OPEN, "text")]
    for name in ("x sidebar", "site-footer", "cookie-notice", "comments-area", "ad", "main-nav", "sidebar-widget", "related-posts"):
        assert html_text.blocks(f'<div class="{name}">text</div>') == [(html_text.ASIDE, "text")]


def test_repeated_runs_of_a_host_go(spark):
    rng = random.Random(2)
    bar = prose(rng, 12)
    own = [prose(rng, 30) for _ in range(4)]
    rows = [(i, f"http://H.example/{i}", f"<body><div>{bar}</div><div>{t}</div></body>") for i, t in enumerate(own)]
    rows += [(9, "http://other/", f"<body><div>{bar}</div></body>"), (10, None, None), (11, "http://h.example/z", "<article>kept</article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for per_task in (html_text.SUFFIXES_PER_TASK, 7):
        html_text.SUFFIXES_PER_TASK, old = per_task, html_text.SUFFIXES_PER_TASK
        got = {r.page_id: (r.text, r.n_chars) for r in html_text.extract_text(pages).collect()}
        html_text.SUFFIXES_PER_TASK = old
        assert [got[i][0] for i in range(4)] == own
        assert got[9] == (bar, len(bar)) and got[10] == ("", 0) and got[11] == ("kept", 4)


def without_host_runs(rows, run=8, least=3):
    """Brute force: text of each article-less page without the runs that ``least`` distinct contents of its host hold."""
    hosts = defaultdict(set)
    for _, host, text in rows:
        hosts[host].add(text)
    out = []
    for page, host, text in rows:
        words = text.split()
        gone = set()
        for at in range(len(words) - run + 1):
            held = f" {' '.join(words[at:at + run])} "
            if sum(held in f" {t} " for t in hosts[host]) >= least:
                gone |= set(range(at, at + run))
        out.append((page, " ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out)


def test_copies_and_quotes_of_a_host_stay(spark):
    rng = random.Random(8)
    bar, quote, copied = prose(rng, 12), prose(rng, 15), prose(rng, 40)
    rows = [(i, "h", f"{bar} {prose(rng, 30)}") for i in range(4)]
    rows += [(10 + i, "h", f"{prose(rng, 20)} {quote} {prose(rng, 20)}") for i in range(2)]
    rows += [(20 + i, "h", copied) for i in range(30)] + [(20, "h", copied)] + [(60 + i, "two", f"{bar} {prose(rng, 9)}") for i in range(2)]
    # the words stand in blocks cut anywhere
    html = lambda t: "<body>" + "".join(f"<p>{' '.join(t.split()[a:a + 6])}</p>" for a in range(0, len(t.split()), 6)) + "</body>"
    pages = spark.createDataFrame([(p, f"http://{h}/{k}", html(t)) for k, (p, h, t) in enumerate(rows)], "page_id long, url string, html string")
    want = without_host_runs(rows)
    assert sorted((r.page_id, r.text) for r in html_text.extract_text(pages.repartition(5)).collect()) == want
    assert (20, copied) in want and dict(want)[0] == rows[0][2].removeprefix(bar + " ") and quote in dict(want)[10]


def test_runs_of_a_host_are_combined_before_the_shuffle(spark):
    """A phrase that all pages of a host hold is counted in every task; only undecided pages look it up."""
    rng = random.Random(9)
    bar = prose(rng, 12)
    pages = spark.createDataFrame(
        [(i, "http://h/", f"<nav>{bar}</nav><article>{i}</article>") for i in range(400)]
        + [(500, "http://h/", f"<p>{bar}</p><p>own {bar[:5]} text</p>"), (501, "http://two/", f"<p>{bar}</p>")],
        "page_id long, url string, html string").repartition(4)
    parsed = html_text._parsed(pages).cache()
    runs = html_text.repeated_runs(parsed, F.col("main").isNull())
    keys = {r.page_key: r.page_id for r in parsed.collect()}
    assert sorted((keys[r.page_key], r.start) for r in runs.collect()) == [(500, k) for k in range(12 - html_text.RUN_TOKENS + 1)]
    plan = runs._jdf.queryExecution().sparkPlan().toString()
    assert "partial_bit_or" in plan and "FlatMapGroups" not in plan
    parsed.unpersist()


def test_articles_lose_what_their_host_repeats(spark):
    """Pages with an article go through the host's runs like any other; what two contents share stays."""
    rng = random.Random(21)
    bar, quote = prose(rng, 12), prose(rng, 12)
    own = [prose(rng, 20) for _ in range(6)]
    texts = [f"{own[k]} {bar}" for k in range(3)] + [f"{own[k]} {quote}" for k in (3, 4)] + [own[5]]
    rows = [(k, f"http://h/{k}", f"<nav>menu {k}</nav><article><p>{t}</p></article>") for k, t in enumerate(texts)]
    rows += [(10, "http://h/10", f"<nav>{own[5]}</nav><article>ten</article>"), (11, "http://h/5", rows[5][2]), (12, "http://two/", rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in html_text.extract_text(pages).collect()}
    assert got == {0: own[0], 1: own[1], 2: own[2], 3: texts[3], 4: texts[4], 5: own[5], 10: "ten", 11: own[5], 12: texts[0]}


def test_suffix_array_of_a_host():
    rng = random.Random(12)
    streams = [[rng.randrange(3) for _ in range(rng.randint(1, 60))] for _ in range(12)]
    streams += [streams[0], [1] * 70, [1] * 9]
    order, _, owner, left = html_text.suffix_array([np.array(s, np.uint32) for s in streams])
    suffixes = [streams[i][-n:] for i, n in zip(owner[order].tolist(), left[order].tolist())]
    assert suffixes == sorted(s[k:] for s in streams for k in range(len(s)))
    contents = np.array([hash(tuple(s)) for s in streams])
    for run in (1, 5, 8):
        content, found = html_text._host_runs([np.array(s, np.uint32) for s in streams], contents, run)
        want = {(c, tuple(s[k : k + run])) for s, c in zip(streams, contents.tolist()) for k in range(len(s) - run + 1)}
        assert len(set(zip(content.tolist(), found.tolist()))) == content.size == len(want)
        assert sorted(Counter(found.tolist()).values()) == sorted(Counter(r for _, r in want).values())


def test_several_distinct_contents(spark):
    rng = random.Random(10)
    some = [rng.getrandbits(64) - 2**63 for _ in range(600)]
    rows = [(k, c) for k in range(200) for c in some[3 * k : 3 * k + 1 + k % 3] * 2]
    got = spark.createDataFrame(rows, "k long, content long").groupBy("k").agg(html_text._several("content").alias("is")).collect()
    assert {r.k for r in got if r["is"]} == {k for k in range(200) if k % 3 == 2}


def test_token_counts_equal_library(docs, spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    extra = spark.createDataFrame([(1, "a<|endoftext|>b <|endoftext|>"), (2, "don't  I'LL\n\n x\t\u0085 中文 ١٢ ½"), (3, None)], "doc_id long, text string")
    for frame, cache in ((docs, tokens.CACHE), (docs, 5), (extra, tokens.CACHE)):
        want = [(r.doc_id, len((r.text or "").encode()), n := len(tokenizer.encode(r.text or "", add_special_tokens=False).ids), n > 512) for r in frame.collect()]
        assert sorted(map(tuple, tokens.count_tokens(frame, path, cache=cache).collect()), key=repr) == sorted(want, key=repr)


def test_repeated_strings_equal_brute_force(docs, spark):
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    count = Counter(b[i : i + 200] for _, b in rows for i in range(len(b) - 199))
    want = []
    for doc, b in rows:
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - 199):
            if count[b[i : i + 200]] > 1:
                gone[i] += 1
                gone[i + 200] -= 1
        cut = np.cumsum(gone)[: len(b)] > 0
        spans = int((np.diff(np.concatenate([[0], cut.astype(int)])) == 1).sum())
        want.append((doc, len(b), int(cut.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~cut].tobytes()).hexdigest()))
    got = substrings.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert substrings.remove_repeats(empty(spark, DOC)).collect() == []


def test_line_of_many_texts_is_split(monkeypatch, spark):
    """A line in other surroundings each time, some of them shared, gives what it gives in one bucket, in no large group."""
    rng = random.Random(12)
    line, passage = prose(rng, 40)[:150], prose(rng, 90)
    texts = [f"{prose(rng, 60)} {line} {prose(rng, 60)}" for _ in range(60)]
    texts += [f"{prose(rng, 30)} {passage} {line} {prose(rng, 30)}" for _ in range(20)]
    texts += [f"{t[:-9]}{prose(rng, 5)}" for t in texts[:5]] + texts[:2]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).cache()
    whole = sorted(map(tuple, substrings.remove_repeats(frame).collect()))
    dealt, repeated = [], substrings._repeated
    monkeypatch.setattr(substrings, "BUCKET_WINDOWS", 3000)
    monkeypatch.setattr(substrings, "_repeated", lambda c, w, n, heavy: dealt.append(heavy) or repeated(c, w, n, heavy))
    assert sorted(map(tuple, substrings.remove_repeats(frame).collect())) == whole
    assert dealt[0] and sum(r[4] > 0 for r in whole) >= 27
    frame.unpersist()


def test_long_text_in_pieces_finds_the_same(monkeypatch, spark):
    text = prose(random.Random(3), 3000)
    frame = spark.createDataFrame([(1, text + " middle " + text[100:900])], "doc_id long, text string")
    whole = substrings.remove_repeats(frame).first()
    monkeypatch.setattr(substrings, "PIECE", 1000)
    assert substrings.remove_repeats(frame).first() == whole and whole.n_spans == 2


@pytest.mark.parametrize("relax, least, cell_rows", [(1.0, 1.0, 8192), (1.0, 1.0, 60), (0.8, 0.9, 60)])
def test_neighbours_equal_brute_force(spark, relax, least, cell_rows):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(700)]
    rows += [(700 + i, rows[20][1]) for i in range(300)] + [(1000, None), (1020, [0.0] * 8), (1040, [float("nan")] * 8), (1060, [None] * 8), (1080, []), (None, rows[1][1]), rows[3]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vantage.nearest(frame, F.col("vec_id") % 20 == 0, relax=relax, shard_rows=200, query_rows=16, cell_rows=cell_rows).collect()
    good = {i: np.array(v) for i, v in rows if i is not None and i < 1000}
    hits = total = 0
    for q in range(0, 1000, 20):
        scores = []
        for i, v in good.items():
            if i != q:
                s = 0.0
                for a, b in zip(good[q], v):
                    s += a * b
                scores.append((-s, i))
        best = sorted(scores)[:20]
        mine = [(-r.score, r.vec_id) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])]
        hits += len({i for _, i in best} & {i for _, i in mine})
        total += 20
        assert relax < 1 or mine == best
    assert hits / total >= least
    assert {r.query_id for r in got} == set(range(0, 1000, 20))
    assert vantage.nearest(empty(spark, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).collect() == []


@pytest.mark.parametrize("relax, least", [(1.0, 1.0), (0.6, 0.9)])
def test_neighbours_in_clusters_skip_cells(spark, monkeypatch, relax, least):
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(30, 24))
    vectors = middles[np.arange(3000) % 30] + rng.normal(size=(3000, 24)) * 0.05
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(3000 + i, [float(i + 1)] * 3) for i in range(5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    routed, elsewhere = [], vantage._elsewhere

    def counted(queries, pivots, radius, factor):
        out = elsewhere(queries, pivots, radius, factor)
        routed.append((out.count(), queries.count() * (len(radius) - 1)))
        return out

    monkeypatch.setattr(vantage, "_elsewhere", counted)
    got = vantage.nearest(frame, F.col("vec_id") % 20 == 0, relax=relax, cell_rows=50, shard_rows=100).collect()
    products = vectors @ vectors.T
    np.fill_diagonal(products, -np.inf)
    hits = sum(r.vec_id in set(np.argsort(-products[r.query_id], kind="stable")[:20]) for r in got if r.query_id < 3000)
    assert hits >= least * 20 * 150 and (relax < 1 or hits == 20 * 150)
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 3000] == [3004, 3003, 3002, 3001]
    assert routed[0][0] < (0.6 if relax == 1 else 0.3) * routed[0][1]


def test_neighbours_with_a_few_long_vectors(spark):
    rng = np.random.default_rng(11)
    vectors = rng.normal(size=(3000, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors[[3, 40, 1001, 2020]] *= [[20.0], [100.0], [1000.0], [0.001]]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in vantage.nearest(frame, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    products = vectors @ vectors.T
    np.fill_diagonal(products, -np.inf)
    assert got == {i: np.argsort(-products[i], kind="stable")[: vantage.K].tolist() for i in range(0, 3000, 20)}


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(900):
        toxic = i % 9 == 0
        words = prose(rng, rng.randint(10, 80)).split()
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scum,", "zqxwe" + prose(rng, 1), "zqxwo" + prose(rng, 1)]))
        rows.append((i, " ".join(words)))
        if i % 2 == 0 or toxic:
            labels.append((i, int(toxic)))
    rows += [(None, None), (2000, ""), rows[9]]
    labels += [(None, 1), (5000, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(frame, marks).collect()}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (i in set(held)) for i in range(900))
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    right = sum(got[i].predicted == int(i % 9 == 0) for i in held)
    assert right / len(held) >= 0.98
    assert got[2000].predicted == 0 and got[None].predicted == 0
    bare = toxicity.score(frame, empty(spark, "doc_id long, toxic int")).collect()
    assert len(bare) == len(rows)
    assert toxicity.without_toxic(frame, marks).columns == frame.columns


def test_licences_are_matched_and_inherited(spark):
    rows = [("a/LICENSE", "Released under the MIT License."), ("a/b/x", "no words"), ("a/b/y", "text\nLicensed under the Apache License, Version 2.0.\nmore " * 30),
            ("a/b/LICENSE.txt", "This work is licensed under the GNU General Public License, version 3."), ("a/c/d/z", ""), ("q", None), ("a/b/c/t", "license to be silly")]
    got = {r.path: (r.license, r.found) for r in licenses.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got == {
        "a/LICENSE": ("MIT", "file"), "a/b/x": ("GPL-3.0", "inherited"), "a/b/y": ("Apache-2.0", "header"), "a/b/LICENSE.txt": ("GPL-3.0", "file"),
        "a/c/d/z": ("MIT", "inherited"), "q": (None, "none"), "a/b/c/t": ("GPL-3.0", "inherited")}
    assert licenses.scan(empty(spark, "path string, text string")).collect() == []


def test_licences_in_parts_of_lines_and_across_lines(spark):
    want = {
        "// SPDX-License-Identifier: MIT\nint x;": "MIT", "# SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
        "/* SPDX-License-Identifier: GPL-3.0-or-later */ int main() { return 0; }": "GPL-3.0",
        "SPDX-License-Identifier: CC-BY-NC-4.0": "CC-BY-NC-4.0", "SPDX-License-Identifier: BSD-2-Clause": "BSD-2-Clause",
        "// SPDX-License-Identifier: AGPL-3.0-only": "AGPL-3.0", "SPDX-License-Identifier: LGPL-3.0": "LGPL-3.0",
        "// Copyright 2020 Foo Inc. Licensed under the MIT license.\nint x;": "MIT",
        "Copyright (c) 2019 Bar GmbH. All rights reserved. Released under the MIT License.": "MIT",
        "Copyright 2021 Baz, this library is licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "   GNU GENERAL PUBLIC LICENSE\n      Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation": "GPL-3.0",
        "   GNU GENERAL PUBLIC LICENSE\n      Version 2, June 1991\n": "GPL-2.0",
        "GNU AFFERO GENERAL PUBLIC LICENSE\n\nVersion 3, 19 November 2007": "AGPL-3.0",
        "   Apache License\n  Version 2.0, January 2004\n http://www.apache.org/licenses/": "Apache-2.0",
        "# This work is\n# licensed under the GNU Lesser General\n# Public License, version 3. More words": "LGPL-3.0",
        "SPDX-License-Identifier: Unheard-1.0": None, "the driver has a license. Then it rained\nand version 2.0 came": None,
        "a license\nto be silly": None,
    }
    files = spark.createDataFrame([(f"d{k}/f", t) for k, t in enumerate(want)], "path string, text string")
    got = {r.path: r.license for r in licenses.scan(files).collect()}
    assert {t: got[f"d{k}/f"] for k, t in enumerate(want)} == want


@pytest.mark.parametrize("texts, groups", [
    (["one two three four five six", "seven eight nine ten eleven twelve"], [0, 1]),
    (["one two three four five six"], [0]),
    ([""], [0]),
    ([None, ""], [0, 1]),
])
def test_ngram_groups_without_shared_shingles(spark, texts, groups):
    rows = [(k, t, "en", "a", 0, 0, 0, "k") for k, t in enumerate(texts)]
    got = ngram_join.linked_groups(spark.createDataFrame(rows, DOC)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == list(enumerate(groups))
    assert ngram_join.one_per_group(spark.createDataFrame(rows, DOC)).count() == len(texts)


GPL_HEADER = """ * This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation; either version {} of the License, or
 * (at your option) any later version."""


def test_licences_of_common_headers(spark):
    want = {
        GPL_HEADER.format(2): "GPL-2.0", GPL_HEADER.format(3): "GPL-3.0",
        GPL_HEADER.format("2.1").replace("GNU General", "GNU Lesser General"): "LGPL-2.1",
        "// Redistribution and use in source and binary forms, with or without\n// modification, are permitted provided that the following conditions are\n// met:": "BSD-2-Clause",
        "// Copyright 2009 The Authors. All rights reserved.\n// Use of this source code is governed by a BSD-style\n// license that can be found in the LICENSE file.": "BSD-3-Clause",
        "# This program and the accompanying materials are made available under the\n# terms of the Eclipse Public License 2.0 which is available at\n# https://www.eclipse.org/legal/epl-2.0/": "EPL-2.0",
        "SPDX-License-Identifier: LGPL-2.1-or-later": "LGPL-2.1", "Permission to use the room was given on Monday.": None,
        "The redistribution and use of water was debated.": None,
    }
    files = spark.createDataFrame([(f"{k}/x", t) for k, t in enumerate(want)], "path string, text string")  # none inherits
    assert {r.path: r.license for r in licenses.scan(files).collect()} == {f"{k}/x": v for k, v in enumerate(want.values())}


def test_licence_matches_equal_brute_force(spark):
    rng = random.Random(17)
    words = sorted({w for _, t in licenses.TEMPLATES for w in re.findall(licenses.WORD, t.lower())} | {"alpha", "beta", "gamma"})
    made = []
    for k in range(300):
        base = re.findall(r"\S+", licenses.TEMPLATES[k % len(licenses.TEMPLATES)][1])
        for _ in range(rng.randint(0, 4)):
            base.insert(rng.randrange(len(base) + 1), rng.choice(words))
        made.append(" ".join(x for x in base if rng.random() > 0.1))
    made += made[:5] + ["", "none of them", "word " * 50_000]
    vectors, idf, other = licenses.template_weights()
    unit = defaultdict(dict)
    for k, _, w, weight in vectors:
        unit[k][w] = weight
    want = {}
    for t in made:
        own = {w: n * idf.get(w, other) for w, n in Counter(re.findall(licenses.WORD, t.lower())).items()}
        length = sum(v * v for v in own.values()) ** 0.5
        scores = [round(sum(v * unit[k].get(w, 0.0) for w, v in own.items()) / length, 6) if length else 0.0 for k in range(len(licenses.TEMPLATES))]
        if max(scores) >= licenses.THRESHOLD:
            best = scores.index(max(scores))
            want[t] = (licenses.TEMPLATES[best][0], scores[best])
    got = {r.m_statement: (r.license, r.cosine) for r in licenses.matched(spark.createDataFrame([(t,) for t in made], "statement string")).collect()}
    assert got.keys() == want.keys() and len(got) > 100
    assert all(got[t][0] == want[t][0] and abs(got[t][1] - want[t][1]) < 2e-6 for t in got)


def test_inheritance_equals_brute_force(spark):
    rng = random.Random(23)
    dirs = sorted({"/".join(rng.choice("abc") for _ in range(rng.randint(0, 6))) for _ in range(150)})
    held = [("/".join(filter(None, [rng.choice(dirs), f"f{k % 3}"])), rng.choice(["X", "Y", "Z"]), rng.choice([0.8, 0.9, 1.0])) for k in range(40)]
    held = list({p: (p, lic, c) for p, lic, c in held}.values())

    def nearest(d):
        while True:
            own = sorted((-c, p, lic) for p, lic, c in held if (p.rsplit("/", 1)[0] if "/" in p else "") == d)
            if own:
                return own[0][2], -own[0][0]
            if not d:
                return None
            d = d.rsplit("/", 1)[0] if "/" in d else ""

    got = licenses.inherited(spark.createDataFrame([(d,) for d in dirs], "dir string"), spark.createDataFrame(held, "path string, license string, cosine double"))
    assert {r.i_dir: (r.dir_license, r.dir_cosine) for r in got.collect()} == {d: nearest(d) for d in dirs if nearest(d)}


def test_licences_of_documents_without_id_and_repeated(spark):
    rows = [(None, "a"), (None, "Released under the MIT License."), (3, "b"), (3, "b"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'s' AS source", "NULL AS lang", "1 AS path", "2 AS license", "'x' AS f_path")
    got = licenses.scan_documents(docs).collect()
    assert sorted((r.doc_id or -1, r.license, r.found) for r in got) == [
        (-1, "MIT", "file"), (-1, "MIT", "inherited"), (3, "MIT", "inherited"), (3, "MIT", "inherited"), (4, "MIT", "inherited")]
    assert licenses.scan_documents(empty(spark, "doc_id long, text string, source string, lang string")).collect() == []
