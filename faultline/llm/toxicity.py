"""Toxicity by weak supervision.

1. Voters look at a text: lexicons written down here, lexicons learned from labelled rows, and
   patterns. The votes of a text are one bit each.
2. A generative model of the votes gives each voter an accuracy in either class, and lets it depend on
   one other voter where the two are correlated beyond the class (a tree of dependencies). It is
   estimated by expectation maximisation over the number of texts per combination of votes; labels
   are one more noisy source for the rows that may be learned from.
3. A linear classifier over the words of all lexicons, and the patterns, learns from the posteriors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import held_out, staged

# At most this many labelled rows, those with the smallest hashes, teach lexicons and anchor votes.
SAMPLE_ROWS = 50_000
# A learned word is in this share of the toxic texts at least, and in this many.
LEAST_SHARE = 0.01
LEAST_TEXTS = 3
# Its log odds, less two standard errors, are above this.
LEAST_ODDS = 1.0
MOST_WORDS = 300
TIERS = 4
# How far a label is trusted.
LABEL_TRUST = 0.95
ROUNDS = 60

# Insults by language; the weak ones have harmless uses.
LEXICONS = {
    "insults_en": "idiot idiots moron morons imbecile stupid dumb pathetic worthless disgusting "
    "loser losers scum vermin fool jerk creep coward",
    "weak_en": "trash clown garbage filth ugly liar useless hate ridiculous shut",
    "insults_de": "idioten dummkopf trottel depp abschaum widerlich erbärmlich wertlos versager "
    "blödmann dreckskerl schwachkopf",
    "insults_fr": "imbécile crétin abruti débile pathétique dégoûtant minable ordure raclure",
    "insults_es": "idiota imbécil estúpido estúpida tonto patético inútil asqueroso basura escoria",
}

# Patterns over the whole text, lower case where they match letters.
PATTERNS = {
    "addressed": r"\b(you|your|du|tu|vous|eres)\b[^.\n]{0,20}\b(idiot|moron|stupid|loser|scum|fool)",
    "masked": r"\b(id[1!*]+ot|st[*@u]+p[1!*]d|m[0*]r[0*]n|l[0*]s[3*]r|sc[*]m|tr[@*]sh)\b",
}


def text_words(text: Column) -> Column:
    return F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+")


def learn_words(labelled: DataFrame) -> list[str]:
    """Words of `text` that mark `toxic` rows, best first; copies of a text count once."""
    texts = labelled.select(
        F.xxhash64("text").alias("copy"), "toxic", text_words(F.col("text")).alias("words")
    ).dropDuplicates(["copy"])
    texts = staged(texts.select("toxic", F.array_distinct("words").alias("words")), "labelled")
    sizes = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic:
        return []
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.ln(a / (toxic + 1)) - F.ln(b / (clean + 1))
    floor = odds - 2 * F.sqrt(1 / a + 1 / b)
    rows = (
        texts.select("toxic", F.explode("words").alias("word"))
        .filter("word != ''")
        .groupBy("word")
        .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
        .filter(F.col("a") >= max(LEAST_TEXTS, math.ceil(LEAST_SHARE * toxic)))
        .withColumn("floor", floor)
        .filter(F.col("floor") > LEAST_ODDS)
        .orderBy(F.desc("floor"), "word")
        .limit(MOST_WORDS)
        .collect()
    )
    return [row["word"] for row in rows]


@dataclass(frozen=True)
class Voters:
    """Groups of words, one voter each, and the patterns."""

    groups: list[list[str]]

    @classmethod
    def of(cls, learned: list[str]) -> Voters:
        written = [words.split() for words in LEXICONS.values()]
        # Dealt out in turn, so that the tiers are alike and more independent of each other.
        tiers = [learned[i::TIERS] for i in range(TIERS) if learned[i::TIERS]]
        return cls([*written, *tiers])

    @property
    def count(self) -> int:
        return len(self.groups) + len(PATTERNS)

    @property
    def vocabulary(self) -> list[str]:
        words = sorted({w for group in self.groups for w in group})
        return [*words, *(f"pattern:{name}" for name in PATTERNS)]

    def hits(self, text: Column) -> Column:
        """The vocabulary found in a text, in a fixed order."""
        known = F.array(*(F.lit(w) for w in self.vocabulary if not w.startswith("pattern:")))
        low = F.lower(F.coalesce(text, F.lit("")))
        marks = F.array(
            *(F.when(low.rlike(p), F.lit(f"pattern:{name}")) for name, p in PATTERNS.items())
        )
        return F.concat(F.array_intersect(known, text_words(text)), F.array_compact(marks))

    def votes(self, hits: Column) -> Column:
        """One bit per voter."""
        bits = [
            F.arrays_overlap(hits, F.array(*(F.lit(w) for w in group))).cast("int") * (1 << i)
            for i, group in enumerate([*self.groups, *([f"pattern:{n}"] for n in PATTERNS)])
        ]
        return sum(bits[1:], bits[0])


@dataclass(frozen=True)
class LabelModel:
    """P(toxic) per combination of votes, and what it was derived from."""

    posterior: dict[int, float]
    prior: float
    accuracies: np.ndarray
    parents: list[int]


def fit_label_model(counts: list[tuple[int, int | None, int]], voters: int) -> LabelModel:
    """Estimate the model from (votes, label or None, number of texts), at most three per votes."""
    votes = np.array([c[0] for c in counts], np.int64)
    label = np.array([-1 if c[1] is None else c[1] for c in counts])
    times = np.array([c[2] for c in counts], float)
    bits = (votes[:, None] >> np.arange(voters)) & 1
    trust = np.where(label == 1, LABEL_TRUST, np.where(label == 0, 1 - LABEL_TRUST, 0.5))
    known = label >= 0
    prior = float(times[label == 1].sum() / max(times[known].sum(), 1)) or 0.01
    prior = min(max(prior, 1e-3), 0.5)
    # To begin with: labels where there are any, and any vote at all elsewhere.
    toxic = np.where(known, trust, np.where(bits.any(axis=1), 0.7, prior / 2))
    parents = [-1] * voters
    for _ in range(ROUNDS):
        weights = np.stack(((1 - toxic) * times, toxic * times))
        prior = min(max(float(weights[1].sum() / weights.sum()), 1e-4), 0.5)
        parents = _dependencies(bits, weights)
        log = np.log(np.stack((np.full(len(votes), 1 - prior), np.full(len(votes), prior))))
        for i, parent in enumerate(parents):
            given = np.zeros(len(votes), int) if parent < 0 else bits[:, parent]
            for y in (0, 1):
                for g in np.unique(given):
                    here = given == g
                    total = weights[y, here].sum()
                    p = (weights[y, here] @ bits[here, i] + 0.5) / (total + 1)
                    log[y, here] += np.where(bits[here, i] == 1, np.log(p), np.log(1 - p))
        from_votes = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        odds = from_votes / np.maximum(1 - from_votes, 1e-12) * trust / (1 - trust)
        toxic = odds / (1 + odds)
    accuracies = np.stack([(weights[y] @ bits + 0.5) / (weights[y].sum() + 1) for y in (0, 1)])
    posterior = dict(zip(votes.tolist(), from_votes.tolist(), strict=True))
    return LabelModel(posterior, prior, accuracies, parents)


def _dependencies(bits: np.ndarray, weights: np.ndarray) -> list[int]:
    """Each voter's parent: the tree of largest mutual information given the class, without the
    branches whose correlation is small."""
    n = bits.shape[1]
    information = np.zeros((n, n))
    for y in (0, 1):
        total = weights[y].sum() + 1
        single = np.clip((weights[y] @ bits + 0.5) / total, 1e-6, 1 - 1e-6)
        both = (bits.T * weights[y]) @ bits / total
        spread = np.sqrt(single * (1 - single))
        correlation = (both - np.outer(single, single)) / np.outer(spread, spread)
        share = total / (weights.sum() + 2)
        squared = np.clip(correlation**2, 0, 0.999)
        information += share * -0.5 * np.log(1 - squared) * (np.abs(correlation) > 0.2)
    np.fill_diagonal(information, 0)
    parents = [-1] * n
    inside = {0} if n else set()
    while len(inside) < n:
        outside = [i for i in range(n) if i not in inside]
        value, i, parent = max((information[i, j], i, j) for i in outside for j in inside)
        parents[i] = parent if value > 0 else -1
        inside.add(i)
    return parents


@dataclass(frozen=True)
class Model:
    voters: Voters
    labels: LabelModel
    vectors: CountVectorizerModel | None
    classifier: LogisticRegressionModel | None

    def score(self, docs: DataFrame, prefix: str = "") -> DataFrame:
        """Add `score`, after `prefix`; all other columns stay as they are, whatever their names."""
        name = f"{prefix}score"
        if self.classifier is None:
            return docs.withColumn(name, F.lit(float(self.labels.prior)))
        # The row is one column, so that none of its names meets one of the model's.
        found = docs.select(
            F.struct("*").alias("_row"), self.voters.hits(F.col("text")).alias("_hits")
        )
        scored = self.classifier.transform(self.vectors.transform(found))
        return scored.select("_row.*", vector_to_array("_probability")[1].alias(name))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from all texts, and from labels of rows that are not held out.

    Labels beyond `sample_rows` are not read: the sample is small enough to be broadcast. What comes
    to the driver is bounded by the number of learned words and of combinations of votes.
    """
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    sample = staged(
        labels.filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"))
        .limit(sample_rows),
        "labels",
    )
    learned = learn_words(
        rows.filter(F.col("text").isNotNull()).join(F.broadcast(sample), "doc_id")
    )
    voters = Voters.of(learned)
    hits = staged(rows.select("doc_id", voters.hits(F.col("text")).alias("_hits")), "hits")
    voted = hits.withColumn("votes", voters.votes(F.col("_hits")))
    counts = (
        voted.join(F.broadcast(sample), "doc_id", "left")
        .groupBy("votes", "toxic")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    label_model = fit_label_model([tuple(r) for r in counts] or [(0, None, 1)], voters.count)
    if not any(r["toxic"] == 1 for r in counts) or not any(r["toxic"] == 0 for r in counts):
        return Model(voters, label_model, None, None)

    posterior = F.create_map(*(F.lit(x) for kv in label_model.posterior.items() for x in kv))
    # Texts with the same hits are one row with their number: all texts count, few rows are fitted.
    grouped = (
        voted.filter(~F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
        .groupBy("_hits", "votes")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("p", F.element_at(posterior, F.col("votes")))
        .withColumn("label", F.explode(F.array(F.lit(0.0), F.lit(1.0))))
        .withColumn("weight", F.col("n") * F.abs(1 - F.col("label") - F.col("p")))
    )
    vectors = CountVectorizerModel.from_vocabulary(
        voters.vocabulary, inputCol="_hits", outputCol="_vector"
    ).setBinary(True)
    regression = LogisticRegression(
        featuresCol="_vector",
        labelCol="label",
        weightCol="weight",
        rawPredictionCol="_raw",
        probabilityCol="_probability",
        predictionCol="_prediction",
        regParam=1e-5,
        standardization=False,
        maxIter=60,
    )
    ready = staged(grouped.select("_hits", "label", "weight"), "posteriors")
    return Model(voters, label_model, vectors, regression.fit(vectors.transform(ready)))


def judge(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Learn, and score every row from its text alone.

    Returns `doc_id, held_out, score, predicted`, one row per input row. Null and empty texts are
    scored like a text on which no voter votes. Without labels of both classes every score is the
    share of toxic texts assumed. Rows without a `doc_id` are not held out; of several labels of a
    `doc_id` the toxic one counts. Other columns are ignored.
    """
    model = fit(docs, labels, sample_rows)
    scored = model.score(docs.select("doc_id", "text"))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
