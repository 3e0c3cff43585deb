"""Toxicity scores by weak supervision.

Voters (lists of words and word beginnings, and writing patterns) vote on every document. Lists are
fixed values or mined from labelled training rows. A generative model of the votes, fitted by
expectation maximisation to the counts of vote patterns over all documents, estimates each voter's
rates in either class and how far voters repeat each other; repeated evidence is discounted. Its
posterior labels train a linear classifier over the single list entries and patterns, which scores.

Texts are read twice at most: the labelled sample for mining, then all documents once for what they
hold of the bounded list of features. Everything after works on that small table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import documents_of, lean, text_chunks, without
from riskweave.llm.shingles import Words
from riskweave.session import staged

# English insults by theme.
LEXICONS = {
    "wits": "idiot idiots idiotic moron morons moronic stupid stupidity dumb dumbass imbecile dimwit halfwit fool foolish brainless clueless",
    "worth": "loser losers worthless pathetic useless failure nobody pitiful miserable incompetent",
    "disgust": "scum trash garbage filth filthy vermin disgusting vile repulsive gross pig pigs rat rats parasite parasites",
    "mockery": "clown clowns joke jerk jerks creep creeps freak freaks weirdo crybaby coward cowards liar liars",
    "violence": "kill murder die hang stab strangle exterminate",
    "swearing": "shit bullshit crap fuck fucking fucker bitch bastard asshole damn",
}
#: Writing patterns that are voters of their own.
PATTERNS = {
    "address": re.compile(rb"(?i)\byou(?:'re| are| all are)? (?:an? |such an? |nothing but |just an? )?(?:idiot|moron|loser|clown|scum|trash|stupid|pathetic|worthless|disgusting)"),
    "command": re.compile(rb"(?i)\b(?:shut up|get lost|go away|go to hell|drop dead|nobody (?:likes|wants) you)\b"),
}
#: Most labelled rows that mining and most posterior-labelled rows that the classifier learns from.
TRAIN_ROWS = 20_000
#: Most mined features, and groups (voters) they are dealt to.
MINED, MINED_VOTERS = 512, 7
#: Fewest toxic rows that a mined feature is seen in, and its least log-odds.
MINED_SUPPORT, MINED_ODDS = 3, 2.5
#: Word beginnings, in bytes, that are features beside whole words.
PREFIXES = (4, 5, 6, 7)
ROUNDS = 50

#: Words end at ASCII bytes that are no letter or digit.
_SPACE = np.ones(256, bool)
_SPACE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from learning: crc32 of its id as text divides by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _all_features(words: Words) -> np.ndarray:
    """Features of every word, one row each: the whole word, then its beginnings."""
    return np.stack([words.hashes(), *[words.hashes(p) + np.uint64(p) for p in PREFIXES]])


def _word_feature(word: str) -> int:
    return int(Words([word.encode()], _SPACE).hashes()[0])


@dataclass
class Features:
    """Sorted feature hashes; entry i of ``voter`` names the voter of feature i. Patterns follow."""

    hashes: np.ndarray
    voter: np.ndarray
    voters: int

    @property
    def size(self) -> int:
        return self.hashes.size + len(PATTERNS)


def _features(mined: list[int]) -> Features:
    """Fixed lists and mined features; a mined one is dealt to a group by its rank."""
    owner = {_word_feature(w): k for k, words in enumerate(LEXICONS.values()) for w in words.split()}
    first = len(LEXICONS)
    for rank, h in enumerate(mined):
        owner.setdefault(h, first + rank % MINED_VOTERS)
    hashes = np.array(sorted(owner), np.uint64)
    patterns = first + MINED_VOTERS + np.arange(len(PATTERNS))
    voter = np.concatenate([[owner[int(h)] for h in hashes], patterns]).astype(np.int64)
    return Features(hashes, voter, first + MINED_VOTERS + len(PATTERNS))


def _sample(documents: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """Labelled training rows with text, at most ``rows`` in the order of a hash of the id."""
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("l_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where(~held_out(F.col("l_id")))
        .orderBy(F.xxhash64("l_id"), "l_id").limit(rows)
    )
    known = staged(known, "toxicity-labels")
    # at most ``rows`` ids and labels, whatever the tables hold
    return staged(documents.join(F.broadcast(known), F.col("doc_id") == F.col("l_id")).select("toxic", "text"), "toxicity-sample")


def _evidence(n1: int, toxic: int, n0: int, clean: int) -> float:
    """Log-likelihood ratio of two rates against one."""
    def part(k: int, n: int, p: float) -> float:
        return (k * np.log(p) if k else 0.0) + ((n - k) * np.log(1 - p) if n > k else 0.0)

    p = (n1 + n0) / (toxic + clean)
    return part(n1, toxic, n1 / toxic) + part(n0, clean, n0 / clean) - part(n1, toxic, p) - part(n0, clean, p)


def mine(sample: DataFrame, most: int = MINED) -> list[int]:
    """Features with the most evidence for toxic rows in the sample, best first."""
    def counted(wanted):
        def count(batches):
            for batch in batches:
                parts = []
                for _, texts in text_chunks(batch.column(1)):
                    words = Words(texts, _SPACE)
                    features = _all_features(words)
                    for i, j in zip(words.at[:-1].tolist(), words.at[1:].tolist()):
                        own = np.unique(features[:, i:j])
                        if wanted is not None:
                            own = own[np.isin(own, wanted.value, assume_unique=True)]
                        parts.append(own)
                values, n = np.unique(np.concatenate(parts) if parts else np.empty(0, np.uint64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], ["feature", "n"])

        return count

    per_class = {bool(r[0]): r[1] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = per_class.get(True, 0), per_class.get(False, 0)
    if not toxic or not clean:
        return []
    schema = "feature long, n long"
    support = max(MINED_SUPPORT, toxic // 200)
    frequent = (
        sample.where("toxic = 1").mapInArrow(counted(None), schema).groupBy("feature").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= support).orderBy(F.col("n").desc(), "feature").limit(200 * most).collect()
    )
    if not frequent:
        return []
    own = np.sort(np.array([r["feature"] for r in frequent], np.int64).view(np.uint64))
    wanted = sample.sparkSession.sparkContext.broadcast(own)
    other = {r[0]: r[1] for r in sample.where("toxic = 0").mapInArrow(counted(wanted), schema)
             .groupBy("feature").agg(F.sum("n")).collect()}
    odds = []
    for r in frequent:
        n1, n0 = r["n"], other.get(r["feature"], 0)
        value = np.log((n1 + 0.5) / (toxic - n1 + 0.5)) - np.log((n0 + 0.5) / (clean - n0 + 0.5))
        if value >= MINED_ODDS:
            odds.append((-_evidence(n1, toxic, n0, clean), r["feature"]))
    # as many candidates as were tried may reach so much evidence by chance about once
    chance = np.log(len(frequent))
    return [int(np.int64(f).view(np.uint64)) for e, f in sorted(odds)[:most] if -e >= chance]


def found_features(documents: DataFrame, features: Features) -> DataFrame:
    """Per document the indices of the features it holds: (doc_id, row_key, held). One map-only pass."""
    shared = documents.sparkSession.sparkContext.broadcast(features)

    def find(batches):
        own = shared.value
        for batch in batches:
            held = []
            for _, texts in text_chunks(batch.column(1)):
                words = Words(texts, _SPACE)
                hits, places = [], []
                if own.hashes.size and words.starts.size:
                    for row in _all_features(words):
                        at = np.minimum(np.searchsorted(own.hashes, row), own.hashes.size - 1)
                        where = np.flatnonzero(own.hashes[at] == row)
                        hits.append(at[where])
                        places.append(where)
                at, where = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (hits, places))
                doc = np.searchsorted(words.at, where, side="right") - 1
                pairs = np.unique(doc * np.int64(1 << 20) + at)
                doc, at = pairs >> 20, pairs & ((1 << 20) - 1)
                cut = np.searchsorted(doc, np.arange(len(texts) + 1))
                for i, text in enumerate(texts):
                    row = at[cut[i] : cut[i + 1]].tolist()
                    held.append(row + [own.hashes.size + k for k, p in enumerate(PATTERNS.values()) if p.search(text)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(held, pa.list_(pa.int32()))], ["doc_id", "row_key", "held"])

    return documents.mapInArrow(lean(find), "doc_id long, row_key string, held array<int>")


@dataclass
class LabelModel:
    """Rates at which voters fire in either class, and the weight left of each beside its like."""

    prior: float
    fires: np.ndarray  # (2, voters)
    weight: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        clean, toxic = (np.where(votes, np.log(f), np.log(1 - f)) @ self.weight for f in self.fires)
        return 1 / (1 + np.exp(np.clip(clean - toxic - np.log(self.prior / (1 - self.prior)), -50, 50)))


def fit_label_model(votes: np.ndarray, counts: np.ndarray, prior: float, rounds: int = ROUNDS) -> LabelModel:
    """Expectation maximisation over the vote patterns; no gold labels.

    The correlation of two voters within a class, beyond what the class explains, measures how far one
    repeats the other; a voter that repeats k others keeps 1 / (1 + k) of its weight. Voters that never
    fire have no say. Toxic documents are those where voters fire: no voter may fire more in clean ones.
    """
    total, n = counts.sum(), votes.shape[1]
    prior = float(np.clip(prior, 1e-4, 0.5))
    rate = (votes * counts[:, None]).sum(axis=0) / total
    fires = np.clip(np.stack([rate * 0.2, np.minimum(rate / prior * 0.8, 0.6)]), 1e-6, 0.999)
    model = LabelModel(prior, fires, (rate > 0).astype(float))
    for _ in range(rounds):
        p = model.posterior(votes)
        fires, repeats = [], np.zeros((n, n))
        for share in (1 - p, p):
            w = share * counts
            f = (w @ votes + 0.01 * rate) / (w.sum() + 0.01 + 1e-9)
            fires.append(np.clip(f, 1e-6, 0.999))
            spread = np.sqrt(f * (1 - f)) + 1e-12
            both = (votes * w[:, None]).T @ votes / max(w.sum(), 1e-9)
            repeats += np.clip((both - np.outer(f, f)) / np.outer(spread, spread), 0, 1) * w.sum() / total
        np.fill_diagonal(repeats, 0)
        fires = np.stack(fires)
        fires[1] = np.maximum(fires[1], fires[0])
        model = LabelModel(float(np.clip(p @ counts / total, 1e-4, 0.5)), fires, (rate > 0) / (1 + repeats.sum(axis=1)))
    return model


def _votes(pattern: np.ndarray, voters: int) -> np.ndarray:
    return (pattern[:, None] >> np.arange(voters)) & 1


def score(documents: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Toxicity of every document: (doc_id, held_out, score, predicted).

    Whole texts; null and empty texts hold no feature and get the score of the intercept. Labels come
    only from rows that are not held out; null labels and ids are left out, of several labels of an id
    the largest counts. Without labelled rows the fixed lists vote alone. Equal texts score equal.
    """
    return _scored(documents_of(documents), labels, train_rows).drop("row_key")


def _scored(docs: DataFrame, labels: DataFrame, train_rows: int) -> DataFrame:
    sample = _sample(docs, labels, train_rows)
    toxic_share = sample.agg(F.avg("toxic")).first()[0]
    features = _features(mine(sample))
    held = staged(found_features(docs, features), "toxicity-features")

    # votes of a document as bits: at most 2 to the power of the voters patterns, 15 voters
    voter = F.expr(f"array({', '.join(str(1 << int(v)) for v in features.voter)})")
    bits = F.aggregate("held", F.lit(0), lambda a, i: a.bitwiseOR(F.element_at(voter, i + 1)))
    patterns = held.select(bits.alias("pattern")).groupBy("pattern").count().collect()
    if not patterns:
        return held.select("doc_id", "row_key", F.lit(False).alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    pattern = np.array([r["pattern"] for r in patterns], np.int64)
    votes = _votes(pattern, features.voters)
    model = fit_label_model(votes, np.array([r["count"] for r in patterns], float), toxic_share or 0.02)

    spark = docs.sparkSession
    posterior = spark.createDataFrame(
        [(int(b), float(p)) for b, p in zip(pattern, model.posterior(votes))], "p_pattern int, posterior double")
    learn = staged(
        held.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
        .withColumn("pattern", bits).join(F.broadcast(posterior), F.col("pattern") == F.col("p_pattern"))
        .select("held", "posterior"), "toxicity-train")
    weights, intercept = _linear(learn, features.size)
    weight = F.expr(f"array({', '.join(f'{w!r}D' for w in weights.tolist())})")
    margin = F.aggregate("held", F.lit(float(intercept)), lambda a, i: a + F.element_at(weight, i + 1))
    return held.select("doc_id", "row_key", held_out(F.col("doc_id")).alias("held_out"), (1 / (1 + F.exp(-margin))).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def _linear(learn: DataFrame, size: int) -> tuple[np.ndarray, float]:
    """Logistic regression on posterior labels: each row counts as toxic and as clean by its posterior."""
    if learn.isEmpty():
        return np.zeros(size), -3.0
    vector = array_to_vector(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.array_contains("held", i).cast("double")))
    x = learn.select(vector.alias("features"), "posterior")
    rows = x.select("features", F.lit(1.0).alias("label"), F.col("posterior").alias("weight")).unionAll(
        x.select("features", F.lit(0.0).alias("label"), (1 - F.col("posterior")).alias("weight")))
    fit = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=25, standardization=False).fit(rows)
    return fit.coefficients.toArray(), fit.intercept


def without_toxic(documents: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Documents, all columns, without those predicted toxic."""
    return without(documents, _scored(documents_of(documents), labels, train_rows).where("predicted = 1"))
