"""Operator 8: toxicity by weak supervision.

1. Voters: words and phrases of a fixed lexicon, and terms (words and word beginnings)
   mined from labelled training rows. A voter votes "toxic" or abstains; one more voter
   says "clean" where all others abstain.
2. Label model: from how often voters fire, alone and in pairs, over all documents, it
   estimates each voter's accuracy (triplets of voters) and which voters depend on each
   other beyond the label (residual correlation); those share their weight. Of the labels
   only the class balance is used.
3. A linear classifier (logistic regression on hashed words and word beginnings) is
   trained on the label model's posteriors over training rows, at most about
   ``TRAIN_ROWS`` with a label (one more vote) and ``UNLABELLED_ROWS`` without (the
   voters' posterior alone), chosen by a hash of the doc_id. Its margins are calibrated
   on the training labels.

Training rows are rows whose crc32(doc_id as text) mod 3 is not 1. A score depends on the
text alone.

Null texts count as empty. A doc_id that has several labels is toxic if one says so;
rows without doc_id have no label. With no usable labels (an empty table, or one class)
the score is the posterior of the fixed lexicon's voters. Other columns are carried.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from .shared import stored, text_of

LEXICON = (
    "arsehole asshole bastard bitch bullshit clown cretin crap damn degenerate despicable "
    "disgusting dumb dumbass fool freak fuck fucking garbage hateful idiot idiotic imbecile "
    "jackass loser lunatic moron moronic pathetic pervert pig prick retard retarded scum "
    "scumbag shit slut stupid sucker trash ugly vermin vile whore worthless wretch"
).split()
PHRASES = ("kill yourself", "shut up", "go to hell", "i hate you", "drop dead", "piece of shit")

#: Bound on the labelled rows the classifier and the mined terms are fitted on.
TRAIN_ROWS = 20_000
#: Bound on the rows without a label that the classifier is fitted on as well.
UNLABELLED_ROWS = 10_000
#: Parts of their features' table, and those in which the classifiers read it: in each of
#: their iterations the sums of many parts are added up in a stage more, at the driver's cost.
TRAIN_PARTS, FIT_PARTS = 12, 3
MINED_TERMS = 100
#: A mined term occurs in so many toxic training rows at least, and so purely.
MINED_ROWS, MINED_PURITY = 3, 0.9
PREFIXES = (4, 6)
FEATURES = 1 << 18
DEFAULT_BALANCE = 0.1
GOLD = 6.0
#: Voters whose residual correlation is above this depend on each other; found in rounds.
DEPENDENT, ROUNDS = 0.2, 3
THRESHOLD = 0.7


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % 3 == 1, F.lit(False))


def with_terms(rows: DataFrame, text: Column) -> DataFrame:
    """Adds ``lower``, the text in lower case, and ``terms``: its distinct words, and the
    beginnings of the longer ones (some twice). The steps are columns of their own:
    functions with a lambda would repeat the split for each use in one expression."""
    columns = rows.columns
    rows = rows.withColumn("lower", F.lower(text))
    rows = rows.withColumn("words", F.array_distinct(F.split("lower", r"[^\p{L}]+")))
    rows = rows.withColumn("long_words", F.filter("words", lambda w: F.length(w) > PREFIXES[0]))
    starts = [F.transform("long_words", lambda w: F.substring(w, 1, n)) for n in PREFIXES]
    return rows.select(*columns, "lower", F.concat(F.array_remove("words", ""), *starts).alias("terms"))


def fired(term_column: Column, lower: Column, voters: list[str]) -> Column:
    """Numbers of the voters that say toxic: terms first, then phrases. ``lower`` is a
    column, not an expression: each phrase would evaluate it again."""
    known = F.array(*map(F.lit, voters))
    by_term = F.transform(
        F.array_intersect(term_column, known), lambda t: F.array_position(known, t).cast("int") - 1
    )
    by_phrase = F.array_compact(
        F.array(*[F.when(F.contains(lower, F.lit(p)), F.lit(len(voters) + i)) for i, p in enumerate(PHRASES)])
    )
    return F.concat(by_term, by_phrase)


def with_votes(term_column: Column, votes: Column) -> Column:
    """The terms, and a mark for each vote and for one vote or more, two, four."""
    marks = F.transform(votes, lambda v: F.concat(F.lit("#"), v.cast("string")))
    levels = F.array_compact(
        F.array(*[F.when(F.size(votes) >= n, F.lit(f"#{n}+")) for n in (1, 2, 4)])
    )
    return F.concat(term_column, marks, levels)


@dataclass
class LabelModel:
    """Weight of each voter's vote, of the vote for clean, and the prior, in log odds."""

    prior: float
    weights: list[float]
    clean: float

    def posterior(self, votes: Column, label: Column | None = None) -> Column:
        """P(toxic | votes). A training row's label is one more vote, of weight GOLD."""
        table = F.array(*map(F.lit, self.weights))
        total = F.aggregate(votes, F.lit(self.prior), lambda s, v: s + F.element_at(table, v + 1))
        odds = F.when(F.size(votes) == 0, F.lit(self.prior + self.clean)).otherwise(total)
        if label is not None:
            odds = odds + F.when(label == 1, GOLD).when(label == 0, -GOLD).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def fit_label_model(votes: DataFrame, n_voters: int, balance: float) -> LabelModel:
    """From ``votes`` (a column of arrays). With x_i whether voter i fires and y the
    label, cov(x_i, x_j) = b (1 - b) d_i d_j for voters independent given the label, b
    the class balance and d_i = P(x_i | toxic) - P(x_i | clean). So v_i^2 = c_ij c_ik /
    c_jk for d_i scaled, in the mean over pairs of other voters that fire along with i.
    Only the n x n counts reach the driver."""
    pairs = votes.select(F.explode("votes").alias("i"), "votes").select(
        "i", F.explode("votes").alias("j")
    )
    counts = np.zeros((n_voters, n_voters))
    for row in pairs.groupBy("i", "j").count().collect():
        counts[row["i"], row["j"]] = row["count"]
    total, silent = votes.agg(
        F.count("*"), F.count(F.when(F.size("votes") == 0, 1))
    ).first()
    total = max(total, 1)
    mean = counts.diagonal() / total
    cov = counts / total - np.outer(mean, mean)
    spread = balance * (1 - balance)
    deviation = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    rest = np.zeros((n_voters, n_voters))
    for _ in range(ROUNDS):
        d = np.minimum(_strengths(cov, mean, spread, rest > 0) / math.sqrt(spread), mean / balance)
        rest = (cov - spread * np.outer(d, d)) / np.outer(deviation, deviation)
        np.fill_diagonal(rest, 0)
        rest[rest < DEPENDENT] = 0
    floor = np.maximum(mean * 0.01, 1 / total)
    toxic = np.clip(mean + (1 - balance) * d, floor, 1 - 1e-6)
    clean = np.clip(mean - balance * d, floor, 1 - 1e-6)
    weights = np.log(toxic / clean) / (1 + rest.sum(axis=1))
    weights[mean == 0] = 1.0
    quiet = min(max(silent / total, 1e-6), 1 - 1e-6)
    # What is not silent is taken for toxic up to the balance.
    silent_toxic = max(0.05, 1 - (1 - quiet) / balance)
    silent_clean = min(1.0, max(0.05, (quiet - balance * silent_toxic) / (1 - balance)))
    return LabelModel(
        prior=math.log(balance / (1 - balance)),
        weights=[float(w) for w in weights],
        clean=min(0.0, math.log(silent_toxic / silent_clean)),
    )


def _strengths(cov: np.ndarray, mean: np.ndarray, spread: float, tied: np.ndarray) -> np.ndarray:
    """v_i of each voter from triplets, without voters that depend on each other."""
    strength = np.zeros(len(mean))
    for i in np.flatnonzero(mean):
        others = np.flatnonzero((cov[i] > 0) & ~tied[i] & (np.arange(len(mean)) != i))
        among = np.where(tied[np.ix_(others, others)], 0, cov[np.ix_(others, others)])
        np.fill_diagonal(among, 0)
        among = np.maximum(among, 0)
        # Least squares over pairs (j, k), so that pairs which say little count little.
        weight = (among**2).sum()
        if weight:
            strength[i] = math.sqrt(cov[i, others] @ among @ cov[i, others] / weight)
        else:  # a voter that fires alone is trusted little
            strength[i] = 0.5 * math.sqrt(mean[i] * spread)
    return strength


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of at most about TRAIN_ROWS labelled rows outside the held-out fold."""
    known = (
        labels.select(labels["doc_id"].cast("long").alias("id"), labels["toxic"].cast("int").alias("toxic"))
        .where("id IS NOT NULL AND toxic IS NOT NULL")
        .where(~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
    )
    share = min(1.0, TRAIN_ROWS / max(known.count(), 1))
    bounded = known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = docs.select(docs["doc_id"].cast("long").alias("id"), text_of(docs).alias("text"))
    # Bounded by TRAIN_ROWS, so broadcast: no text is shuffled.
    return stored(rows.join(F.broadcast(bounded), "id").select("text", "toxic"), "training")


def unlabelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic), toxic null, of at most about UNLABELLED_ROWS rows outside the
    held-out fold that have no label."""
    share = min(1.0, UNLABELLED_ROWS / max(docs.count(), 1))
    rows = docs.select(docs["doc_id"].cast("long").alias("id"), text_of(docs).alias("text"))
    some = rows.where(
        ~held_out(F.col("id")) & (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1_000_000)) < int(share * 1_000_000))
    )
    known = labels.where(labels["toxic"].isNotNull()).select(labels["doc_id"].cast("long").alias("id"))
    left = some.where("id IS NOT NULL").join(known, "id", "left_anti")
    return left.select("text", F.lit(None).cast("int").alias("toxic"))


def mined_terms(train: DataFrame, balance: float) -> list[str]:
    """Terms of toxic rows that are no accident: of terms in n rows, a share of
    balance^n would be in toxic rows alone."""
    counts = stored(
        with_terms(train, F.col("text"))
        .select("toxic", F.explode(F.array_distinct("terms")).alias("term"))
        .groupBy("term")
        .agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
        .where(F.col("n") >= MINED_ROWS),
        "terms",
    )
    n_terms = max(counts.count(), 2)
    least = max(MINED_ROWS, math.ceil(math.log(n_terms) / -math.log(balance)))
    good = counts.where((F.col("bad") >= least) & (F.col("bad") >= MINED_PURITY * F.col("n")))
    return [r["term"] for r in good.orderBy(F.desc("bad"), "term").limit(MINED_TERMS).collect()]


@dataclass
class Scorer:
    """score(docs) adds ``score`` and ``predicted`` to any table with a text column."""

    voters: list[str]
    labels: LabelModel
    linear: object = None
    slope: float = 1.0
    shift: float = 0.0

    def score(self, docs: DataFrame) -> DataFrame:
        columns = docs.columns
        text = F.col("row.text").cast("string")
        rows = docs.select(F.struct(*[docs[c] for c in columns]).alias("row"))
        rows = with_terms(rows, F.coalesce(text, F.lit("")))
        rows = rows.withColumn("votes", fired(F.col("terms"), F.col("lower"), self.voters)).drop("lower")
        if self.linear is None:
            rows = rows.withColumn("score", self.labels.posterior(F.col("votes")))
        else:
            rows = rows.withColumn("terms", with_votes(F.col("terms"), F.col("votes")))
            margin = _margin(self.linear, HashingTF(**_HASH).transform(rows).drop("terms"))
            rows = margin.withColumn(
                "score", 1 / (1 + F.exp(-(F.col("margin") * self.slope + self.shift)))
            )
        # A generator: a filter on the score stays above it, or it would repeat the scoring.
        rows = rows.withColumn("score", F.explode(F.array("score")))
        return rows.select(
            *[F.col("row")[c].alias(c) for c in columns if c not in ("score", "predicted")],
            "score",
            (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        )


_HASH = {"inputCol": "terms", "outputCol": "features", "numFeatures": FEATURES, "binary": True}


def _margin(model, rows: DataFrame) -> DataFrame:
    """``margin`` of rows with ``features``; the model's other outputs are not made."""
    out = model.transform(rows)
    return out.withColumn("margin", vector_to_array("rawPrediction")[1]).drop(
        "features", "rawPrediction"
    )


def fit(docs: DataFrame, labels: DataFrame) -> Scorer:
    train = training_rows(docs, labels)
    n, bad = train.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    usable = 0 < bad < n
    balance = min(max(bad / n, 0.005), 0.5) if usable else DEFAULT_BALANCE
    voters = list(dict.fromkeys(LEXICON + (mined_terms(train, balance) if usable else [])))
    all_votes = with_terms(docs.select(text_of(docs).alias("text")), F.col("text"))
    all_votes = stored(all_votes.select(fired(F.col("terms"), F.col("lower"), voters).alias("votes")), "votes")
    model = fit_label_model(all_votes, len(voters) + len(PHRASES), balance)
    if not usable:
        return Scorer(voters, model)
    ready = with_terms(train.unionByName(unlabelled_rows(docs, labels)), F.col("text"))
    ready = ready.withColumn("votes", fired(F.col("terms"), F.col("lower"), voters))
    ready = ready.select(
        with_votes(F.col("terms"), F.col("votes")).alias("terms"),
        model.posterior(F.col("votes"), F.col("toxic")).alias("p"),
        "toxic",
    )
    ready = HashingTF(**_HASH).transform(ready).drop("terms")
    # Bounded by both limits; each iteration is a job over these few parts.
    ready = stored(ready.coalesce(TRAIN_PARTS), "posteriors").coalesce(FIT_PARTS)
    # A soft label is both labels, weighted.
    sides = F.array(
        F.struct(F.lit(1.0).alias("label"), F.col("p").alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (1 - F.col("p")).alias("weight")),
    )
    both = ready.select("features", F.inline(sides))
    linear = LogisticRegression(
        weightCol="weight", regParam=0.02, maxIter=40, standardization=False
    ).fit(both)
    linear.setProbabilityCol("").setPredictionCol("")
    margins = _margin(linear, ready.where("toxic IS NOT NULL"))
    # Stored: each job of the next fit would carry the classifier's coefficients to its tasks.
    margins = stored(margins.select("margin", F.col("toxic").cast("double").alias("label")), "margins")
    margins = VectorAssembler(inputCols=["margin"], outputCol="x").transform(margins)
    fitted = LogisticRegression(featuresCol="x", maxIter=30, regParam=1e-4, standardization=False).fit(margins)
    slope, shift = float(fitted.coefficients[0]), float(fitted.intercept)
    if slope <= 0:
        slope, shift = 1.0, 0.0
    return Scorer(voters, model, linear, slope, shift)
