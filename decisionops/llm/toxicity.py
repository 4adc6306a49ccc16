"""Toxicity scores: gradient-boosted trees over dense features, calibrated by
isotonic regression.

Features of a whole text: densities of a lexicon (hits, weighted hits, hits by
stem, the strongest hit), hits near a second-person pronoun, shares of capital
letters and of shouted words, punctuation, and obfuscation (words that mix
letters with digits or symbols, hits that show only once such disguise is
undone).

The lexicon is learned: words, and word beginnings of four to six letters, that
are much more frequent in toxic than in other training texts, besides a small
list of plain English insults.  Training rows are split by an id hash into
three parts, so that the lexicon, the trees and the calibration each see rows
the others did not: a hit in the trees' rows is then as meaningful as in any
new text.

Training sample: at most ``SAMPLE_ROWS`` labelled rows, those with the
smallest hashes of id, text and label, equal rows once.  This bound is the
documented size of the training set, whatever ids repeat; scoring covers all rows.

Cases: null and empty texts have zero features and get the score of a text
without hits; documents without labels are only scored; null labels are not
learned from; with no training rows of both labels the score is the share of
toxic training rows (0 if there are none); a document labelled twice with
different labels counts twice; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter

import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, sample_bounds, sample_hash, small_batches, stored

SAMPLE_ROWS = 24_000
LEXICON_SIZE = 3000
MIN_DOCS = 4              # texts that hold a term, at least
MIN_LOG_ODDS = 2.5
STEMS = (4, 5, 6)         # lengths of word beginnings
NEAR = 5                  # words on either side of a second-person pronoun
THRESHOLD = 0.7
TREES, DEPTH = 20, 4

SEED_LEXICON = (
    "idiot idiots idiotic moron morons stupid stupidity dumb fool fools loser losers scum trash garbage clown "
    "worthless pathetic disgusting filthy vermin imbecile retard jerk creep bastard bitch shut hate").split()
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer "
    "tú ti usted ustedes vosotros su sus".split())
_UNDISGUISE = str.maketrans("013457@$!|", "oieastasii")
_UPPER = string.ascii_uppercase.encode()
_PUNCT = string.punctuation.encode()
_EDGES = string.punctuation + "«»“”‘’¡¿…"
_INNER = re.compile(r"[\W_]+")

FEATURES = ("hits", "density", "weight_density", "stem_hits", "stem_density", "strongest", "near_you", "near_density",
            "upper_share", "shouted_share", "punct_share", "exclaim_rate", "mixed_rate", "disguised_hits", "log_words",
            "distinct_hits")


def plain(word: str) -> str:
    return word.strip(_EDGES)


def undisguised(word: str) -> str:
    return _INNER.sub("", word.translate(_UNDISGUISE))


def terms_of(text: str) -> set[str]:
    """Words of a text and their beginnings (marked with a trailing *)."""
    out = set()
    for w in set(map(plain, set(text.lower().split()))):
        out.add(w)
        out.update(w[:k] + "*" for k in STEMS if len(w) > k)
    out.discard("")
    return out


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """``rows`` (text, toxic) -> term -> log odds.  Terms are counted per text
    in the tasks, added up by Spark, and only the strongest are collected."""
    def count(batches):
        for pdf in batches:
            both = {0: Counter(), 1: Counter()}
            for text, toxic in zip(pdf["text"], pdf["toxic"]):
                both[int(toxic)].update(terms_of(text or ""))
            names = list(both[0] | both[1])
            yield pd.DataFrame({"term": names, "clean": [both[0][t] for t in names], "bad": [both[1][t] for t in names]})

    n = {int(r["toxic"]): r["count"] for r in rows.groupBy("toxic").count().collect()}
    odds = (F.log((F.col("bad") + 0.5) / (n.get(1, 0) + 1.0)) - F.log((F.col("clean") + 0.5) / (n.get(0, 0) + 1.0)))
    counted = (rows.select("text", "toxic").mapInPandas(count, "term string, clean long, bad long")
               .groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
               .where(F.col("bad") >= MIN_DOCS).withColumn("w", odds).where(F.col("w") >= MIN_LOG_ODDS)
               .orderBy(F.col("w").desc(), "term").limit(LEXICON_SIZE))
    lexicon = {w: 4.0 for w in SEED_LEXICON}
    lexicon.update({r["term"]: float(r["w"]) for r in counted.collect()})
    return lexicon


class Scorer:
    """Features of a text under a lexicon; what a word is worth is remembered
    for a bounded number of words."""

    def __init__(self, lexicon: dict[str, float]):
        self.words = {t: w for t, w in lexicon.items() if not t.endswith("*")}
        self.stems = {t[:-1]: w for t, w in lexicon.items() if t.endswith("*")}
        self.known: dict[str, tuple] = {}

    def worth(self, raw: str) -> tuple:
        """(word weight, stem weight, weight once undisguised, letters mixed with others)."""
        got = self.known.get(raw)
        if got is None:
            w = plain(raw)
            stem = max((self.stems.get(w[:k], 0.0) for k in STEMS if len(w) > k), default=0.0)
            direct, mixed, hidden = self.words.get(w, 0.0), not w.isalpha() and any(c.isalpha() for c in w), 0.0
            if not direct and mixed:
                hidden = self.words.get(undisguised(raw), 0.0) or self.words.get(undisguised(w), 0.0)
            got = (direct, stem, hidden, mixed)
            if len(self.known) < 200_000:
                self.known[raw] = got
        return got

    def __call__(self, text: str | None) -> list[float]:
        text = text or ""
        raw = text.encode()
        words = text.lower().split()
        n, size = max(1, len(words)), max(1, len(raw))
        counts = Counter(words)
        hits = weight = stem_hits = strongest = mixed = disguised = 0.0
        found = set()
        for w, c in counts.items():
            direct, stem, hidden, is_mixed = self.worth(w)
            mixed += c * is_mixed
            if direct or hidden:
                hits += c
                disguised += c * (not direct)
                found.add(w)
            if stem:
                stem_hits += c
                found.add(w)
            best = max(direct, stem, hidden)
            weight += c * best
            strongest = max(strongest, best)
        near = 0
        if found and any(plain(w) in SECOND_PERSON for w in counts):
            at = [i for i, w in enumerate(words) if plain(w) in SECOND_PERSON]
            near_at = {j for i in at for j in range(i - NEAR, i + NEAR + 1)}
            near = sum(1 for j in near_at if 0 <= j < len(words) and words[j] in found)
        upper = size - len(raw.translate(None, _UPPER)) if raw else 0
        shouted = sum(1 for w in text.split() if w.isupper() and len(w) > 2) if upper > 2 else 0
        punct = size - len(raw.translate(None, _PUNCT)) if raw else 0
        return [hits, 100 * hits / n, 100 * weight / n, stem_hits, 100 * stem_hits / n, strongest, float(near),
                100 * near / n, upper / size, shouted / n, punct / size, 100 * text.count("!") / n, 100 * mixed / n,
                disguised, math.log1p(len(words)), float(len(found))]


_SCORERS: dict = {}


def features_column(docs: DataFrame, lexicon: dict[str, float], text_col: str = "text"):
    shared = small_batches(docs).sparkSession.sparkContext.broadcast(lexicon)          # at most LEXICON_SIZE terms and the seed list

    @F.pandas_udf("array<double>")
    def dense(texts: pd.Series) -> pd.Series:
        key = hash(frozenset(shared.value.items()))
        if key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = Scorer(shared.value)
        return pd.Series([_SCORERS[key](t) for t in texts])

    return dense(F.col(text_col))


class Model:
    """Lexicon, trees and calibration."""

    def __init__(self, lexicon, trees, calibration, constant: float):
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant

    def score(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """``docs`` with a column ``_score``; the text column is not kept."""
        if self.trees is None:
            return docs.drop(text_col).withColumn("_score", F.lit(self.constant))
        rows = docs.withColumn("_f", array_to_vector(features_column(docs, self.lexicon, text_col))).drop(text_col)
        rows = _raw(self.trees.transform(rows)).drop("_f")
        out = self.calibration.transform(rows)
        return out.withColumn("_score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("_score")))).drop("_p")


def _raw(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_p", F.get(vector_to_array("_prob"), F.lit(1))).drop("_raw", "_prob", "_pred")


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """u (hash of id, text and label), text, toxic: at most ``SAMPLE_ROWS`` labelled rows of ``docs``
    (doc_id, text), by ``labels`` (label_id, toxic).  They are chosen on hashes; texts are fetched
    for the chosen rows only, whose keys are broadcast."""
    d = docs.select("doc_id", "text", F.xxhash64("text").alias("version"))
    known = d.select("doc_id", "version").join(labels, F.col("doc_id") == F.col("label_id")).where(F.col("toxic").isin(0, 1))
    known = stored(known.select("doc_id", "version", F.col("toxic").cast("double").alias("toxic"), F.lit("all").alias("all"))
                   .withColumn("u", sample_hash("doc_id", "version", "toxic", salt="toxicity")), "toxicity_labelled")
    bound = sample_bounds(known, "all", "u", SAMPLE_ROWS).get("all", 0)
    keys = known.where(F.col("u") < bound).select(F.col("doc_id").alias("_id"), F.col("version").alias("_of"), "u", "toxic")
    rows = d.join(F.broadcast(keys.dropDuplicates(["u"])), (F.col("doc_id") == F.col("_id")) & (F.col("version") == F.col("_of")))
    return rows.groupBy("u").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic"))


def fit(rows: DataFrame) -> Model:
    """``rows`` (u, text, toxic): a bounded sample of labelled rows."""
    rows = rows.withColumn("part", F.pmod(F.xxhash64("u"), F.lit(10)))
    rows = stored(rows.select("text", "toxic", "part"), "toxicity_sample")
    lexicon = learn_lexicon(rows.where("part < 5"))
    rest = rows.where("part >= 5")
    dense = stored(rest.select("toxic", "part", features_column(rest, lexicon).alias("f")), "toxicity_features")
    dense = dense.withColumn("_f", array_to_vector("f")).cache()
    stats = {r["part"]: r for r in dense.groupBy((F.col("part") < 8).alias("part")).agg(
        F.countDistinct("toxic").alias("kinds"), F.avg("toxic").alias("share"), F.count("toxic").alias("n")).collect()}
    if True not in stats or stats[True]["kinds"] < 2:
        share = rows.agg(F.avg("toxic")).first()[0]
        return Model(lexicon, None, None, float(share or 0.0))
    gbt = GBTClassifier(featuresCol="_f", labelCol="toxic", predictionCol="_pred", maxIter=TREES, maxDepth=DEPTH,
                        stepSize=0.2, maxBins=32, minInstancesPerNode=5, seed=7)
    trees = gbt.setProbabilityCol("_prob").setRawPredictionCol("_raw").fit(dense.where("part < 8"))
    # without rows of both labels left for it, calibration uses the trees' rows
    own = False in stats and stats[False]["kinds"] == 2 and stats[False]["n"] >= 200
    held = _raw(trees.transform(dense.where("part >= 8") if own else dense)).select("_p", "toxic")
    calibration = IsotonicRegression(featuresCol="_p", labelCol="toxic", predictionCol="_score").fit(held)
    dense.unpersist()
    return Model(lexicon, trees, calibration, 0.0)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted.  Labels are learned from documents
    that are not held out (crc32 of the id modulo 3 is not 1)."""
    held = F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(False))
    d = docs.select("doc_id", "text")
    known = labels.select(F.col("doc_id").alias("label_id"), "toxic").where("toxic is not null")
    scored = fit(training_sample(d.where(~held), known)).score(d)
    return scored.select("doc_id", held.alias("held_out"), F.col("_score").alias("score"),
                         (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))
