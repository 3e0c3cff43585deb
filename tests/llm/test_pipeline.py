"""The corpus pipeline: every stage against brute force on what its predecessor kept."""

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from riskweave.llm import decontaminate, mixing, ngram_join, substrings, toxicity  # noqa: E402

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(3, 8))) for _ in range(n))


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(21)
    items = [prose(rng, 30) for _ in range(3)]
    passage = prose(rng, 60)
    texts = [prose(rng, rng.randint(20, 150)) for _ in range(60)]
    texts += [texts[0], texts[1] + " more", texts[0]]                                      # copies, and a near copy
    texts += [f"{prose(rng, 40)} {items[k % 3]} {prose(rng, 40)}" for k in range(4)]       # benchmark passages
    texts += [f"{prose(rng, 40)} {passage} {prose(rng, 40)}" for _ in range(5)]            # a repeated passage
    texts += [None, "", "  ", passage]
    rows = [(i, t, "en", [None, "a", "b"][i % 3], len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, prose(rng, 50), "de", "b", 0), rows[5]]
    out = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, DOC).repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(0, 60, 4)], "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return str(out)


def as_rows(df):
    return sorted(map(tuple, df.select("doc_id", "text", "lang", "source", "n_chars").collect()), key=repr)


def brute_one_per_group(rows):
    rows = sorted(set(rows), key=repr)
    sets, label = [shingles(r[1]) for r in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared):
                label = [label[j] if x == label[i] else x for x in label]
    groups = {}
    for r, s, x in zip(rows, sets, label):
        groups.setdefault((x,) if s else ("alone", repr(r)), []).append(r)
    return sorted((min(g, key=lambda r: (r[0] is None, r[0])) for g in groups.values()), key=repr)


def brute_without_repeats(rows, length=200):
    texts = [(r[1] or "").encode() for r in rows]
    seen = {}
    for t in texts:
        for o in range(len(t) - length + 1):
            seen[t[o : o + length]] = seen.get(t[o : o + length], 0) + 1
    out = []
    for r, t in zip(rows, texts):
        gone = [False] * len(t)
        for o in range(len(t) - length + 1):
            if seen[t[o : o + length]] > 1:
                gone[o : o + length] = [True] * length
        left = bytes(b for b, g in zip(t, gone) if not g).decode("utf-8", "ignore")
        if not any(gone):
            out.append(r)
        elif left:
            out.append((r[0], left, *r[2:4], len(left)))
    return sorted(out, key=repr)


def brute_clean(rows, items):
    wanted = [shingles(t) for t in items]
    return [r for r in rows if not any(len(w & shingles(r[1])) >= 0.75 * len(w) for w in wanted)]


def test_stages_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    toxic = {(r.doc_id, r.predicted) for r in toxicity.score(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()}
    want, seen = as_rows(docs), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        seen.append(name)
        if name == "toxicity":
            want = [r for r in want if (r[0], 1) not in toxic]
        elif name == "near_duplicates":
            want = brute_one_per_group(want)
        elif name == "suffix_dedup":
            want = brute_without_repeats(want)
        elif name == "decontamination":
            want = brute_clean(want, items)
        if name != "source_mix":
            assert docs.columns == DOC.replace(" long", "").replace(" string", "").split(", "), name
            assert as_rows(docs) == want, name
        docs = docs.checkpoint() if spark.sparkContext._jsc.sc().getCheckpointDir().isDefined() else docs
    assert seen == ["toxicity", "near_duplicates", "suffix_dedup", "decontamination", "source_mix"]
    mixed = {(r.doc_id, r["size"]) for r in docs.collect()}
    assert mixed == {(r[0], len((r[1] or "").encode().split())) for r in want}
    assert len(want) < 75 and sum(len(r[1] or "") for r in want) > 5000


def test_run_writes_and_rereads_the_stages(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "size", "source_size", "target", "taken"} <= set(got.columns) and got.count() > 50


def test_pipeline_of_an_empty_table(spark, folder, tmp_path):
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_keep_columns_of_any_name(spark, folder):
    names = ["n_bytes", "n_removed", "n_spans", "kept_text", "kept_sha256", "_row_key", "key", "whole", "gone", "row_key", "component"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    wide = docs.selectExpr("*", *[f"concat('{n}', doc_id) AS {n}" for n in names])
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    for out in (substrings.without_repeats(wide), ngram_join.one_per_group(wide), decontaminate.clean(wide, benchmark),
                toxicity.without_toxic(wide, labels)):
        assert out.columns == wide.columns
        rows = out.where("doc_id IS NOT NULL").collect()
        assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)
    assert mixing.mix(wide).count() == docs.count()
