"""Co-trained quality classifier over two views of a document.

The text view sees nothing but the text: its words, the shapes of its words (letters folded to a
and A, digits to 9), how words and lines repeat and how long they are. The page view sees nothing of
the text: source, language and stated length. All models are logistic regressions; the text view has
one of words and one of shapes, whose margins are added with the weights that fit held-out labels,
so that words count for as much as they tell. Both views start from the labelled documents; each
round, each view scores all unlabelled documents and labels those it is surest of, for the other
view to learn from. Held-out labels calibrate both, and their calibrated odds are combined into
one score for every document. Features of all documents are written once and scored once a round
and at the end; scoring shuffles no document. Fitting uses a bounded sample of labels.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import FeatureHasher, HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import WORD, having, let, scratch, written

LABELLED_ROWS = 4000
SHAPES, WORDS, PAGE_FEATURES = 1 << 11, 1 << 12, 1 << 8
ROUNDS = 3
# Most documents a view passes on per round, and how sure it must be of them.
PASSED_ON, SURE = 400, 0.95
ITERATIONS, TOLERANCE, REGULARISATION, CALIBRATION = 40, 1e-4, 1e-3, 1e-4
NEWTON_STEPS = 100
# The models of each view, by the columns of their features.
PARTS = {"text": ("shape_features", "word_features"), "page": ("page_features",)}
FEATURES = (*PARTS["text"], *PARTS["page"])


class View(NamedTuple):
    """Models, and the line that turns their margins into log odds."""

    models: dict[str, LogisticRegressionModel]
    slopes: dict[str, float]
    offset: float


class Classifier(NamedTuple):
    """Both views, and the weights with which their log odds are added up."""

    views: dict[str, View]
    weights: dict[str, float]
    offset: float


# ---- views ------------------------------------------------------------------------


def with_features(docs: DataFrame) -> DataFrame:
    """doc_id and all feature vectors of every row of docs; columns that begin with _ are kept."""
    text = F.col("_text")
    kept = [c for c in docs.columns if c.startswith("_") or c == "doc_id"]
    rows = docs.withColumn("_text", F.coalesce("text", F.lit("")))
    shape = F.regexp_replace(text, r"\p{Ll}+", "a")
    shape = F.regexp_replace(F.regexp_replace(shape, r"\p{Lu}+", "A"), r"\p{Nd}+", "9")
    lines = let(F.split(text, "\n", -1), lambda x: F.struct(
        F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))
    rows = rows.select(
        *kept, F.regexp_extract_all(shape, F.lit(WORD), F.lit(0)).alias("_shapes"),
        F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)).alias("_words"),
        lines.alias("_l"), F.length(text).alias("_size"),
        F.coalesce(F.col("source").cast("string"), F.lit("-")).alias("_source"),
        F.coalesce(F.col("lang").cast("string"), F.lit("-")).alias("_lang"),
        F.log1p(F.greatest(F.coalesce(F.col("n_chars").cast("double"), F.lit(0.0)), F.lit(0.0)))
        .alias("_stated"),
    )
    words = F.col("_words")
    same = F.size(F.filter(words, lambda x, i: x == F.get(words, i - 1)))
    n, n_lines = F.greatest(F.size(words), F.lit(1)), F.greatest(F.col("_l.n"), F.lit(1))
    rows = rows.select(
        *kept, "_shapes", "_words", "_source", "_lang", "_stated",
        (F.size(F.array_distinct(words)) / n).alias("_distinct"), (same / n).alias("_same"),
        (F.col("_size") / n).alias("_mean"), F.log1p(F.size(words).cast("double")).alias("_many"),
        F.log1p(F.col("_l.n").cast("double")).alias("_lines"),
        F.log1p(F.col("_size") / n_lines).alias("_width"),
        (1 - F.col("_l.d") / n_lines).alias("_again"),
    )
    shapes, known, page = FEATURES
    rows = HashingTF(inputCol="_shapes", outputCol="_counts", numFeatures=SHAPES).transform(rows)
    rows = Normalizer(inputCol="_counts", outputCol="_share", p=1.0).transform(rows)
    layout = ["_distinct", "_same", "_mean", "_many", "_lines", "_width", "_again"]
    rows = VectorAssembler(inputCols=["_share", *layout], outputCol=shapes).transform(rows)
    rows = HashingTF(
        inputCol="_words", outputCol="_present", numFeatures=WORDS, binary=True
    ).transform(rows)
    rows = Normalizer(inputCol="_present", outputCol=known, p=2.0).transform(rows)
    rows = FeatureHasher(
        inputCols=["_source", "_lang", "_stated"], outputCol=page, numFeatures=PAGE_FEATURES
    ).transform(rows)
    return rows.select(*kept, *FEATURES)


# ---- training ------------------------------------------------------------------------


def agreed(labels: DataFrame) -> DataFrame:
    """(doc_id, _label) of the documents whose labels do not contradict each other."""
    return labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("low"), F.max("quality").alias("high")
    ).where("low = high").select("doc_id", F.col("low").cast("double").alias("_label"))


def sample(docs: DataFrame, known: DataFrame, folder: str) -> DataFrame:
    """Views of at most LABELLED_ROWS labelled documents, those of smallest hash.

    (doc_id, _label, _fold): one document in four is of fold 0, for calibration.
    """
    order = [F.xxhash64("doc_id", F.lit("sample")), F.col("doc_id")]
    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    chosen = written(
        ids.join(known, "doc_id").orderBy(*order).limit(LABELLED_ROWS), f"{folder}/chosen"
    )
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(4)).alias("_fold")
    # At most LABELLED_ROWS ids are broadcast. Of rows that share an id, that of least hash is taken.
    facts = ["text", "source", "lang", "n_chars"]
    some = docs.select("doc_id", F.struct(F.xxhash64(*facts).alias("row"), *facts).alias("one"))
    some = some.join(F.broadcast(chosen.select("*", fold)), "doc_id")
    one = some.groupBy("doc_id", "_label", "_fold").agg(F.min("one").alias("one"))
    rows = one.select("doc_id", "_label", "_fold", *[f"one.{c}" for c in facts])
    return written(with_features(rows).repartition(4), f"{folder}/sample")


def all_features(docs: DataFrame, folder: str) -> DataFrame:
    """Features of every row, and a hash of the row (_row) that tells rows of one id apart."""
    facts = ["text", "source", "lang", "n_chars"]
    rows = docs.select("doc_id", *facts, F.xxhash64(*facts).alias("_row"))
    return written(with_features(rows), f"{folder}/features")


def regression(features: str) -> LogisticRegression:
    # Words are few times present and of equal length already: scaled by their spread, rare ones
    # would rule.
    return LogisticRegression(
        featuresCol=features, labelCol="_label", maxIter=ITERATIONS, tol=TOLERANCE, regParam=REGULARISATION,
        standardization=features != PARTS["text"][1],
    )


def margin(raw: Column | str) -> Column:
    return F.get(vector_to_array(raw), F.lit(1))


def train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> Classifier | None:
    """Both views, co-trained and calibrated; None where the labels are not of two kinds."""
    return _trained(docs, labels, rounds)[0]


def _trained(
    docs: DataFrame, labels: DataFrame, rounds: int
) -> tuple[Classifier | None, DataFrame | None]:
    """What train gives, and the features of all rows of docs if the rounds had them written."""
    folder = scratch(docs.sparkSession, "cotraining")
    known = written(agreed(labels), f"{folder}/known")
    rows = sample(docs, known, folder)
    own = rows.where("_fold <> 0").select("doc_id", "_label", *FEATURES)
    held = rows.where("_fold = 0")
    shares = own.agg(F.sum("_label"), F.count(F.lit(1))).first()
    if not shares[1] or shares[0] in (0.0, float(shares[1])):
        return None, None
    prior = shares[0] / shares[1]
    # At most LABELLED_ROWS numbers, like the margins below.
    truth = np.array([r[0] for r in held.orderBy("doc_id").select("_label").collect()])
    pool = all_features(docs, folder) if rounds else None

    given: dict[str, list[DataFrame]] = {v: [] for v in PARTS}
    for turn in range(rounds + 1):
        views, margins = {}, {}
        for view, parts in PARTS.items():
            learned = own
            for passed in given[view]:
                learned = learned.unionByName(passed)
            models = {p: regression(p).fit(learned.select("_label", p)) for p in parts}
            margins[view] = _margins(held, models)
            views[view] = View(models, *_line(margins[view], truth, prior))
        if turn == rounds:
            break
        scored = written(_sure(pool, views, known), f"{folder}/sure-{turn}")
        for view, other in zip(PARTS, reversed(PARTS), strict=True):
            new = scored.select("doc_id", F.col(view).alias("p"))
            for passed in given[other]:
                new = new.join(F.broadcast(passed.select("doc_id")), "doc_id", "left_anti")
            # At most PASSED_ON + 1 ids are broadcast.
            sure = scored.select("doc_id", "_row").join(F.broadcast(_surest(new, prior)), "doc_id")
            sure = pool.join(F.broadcast(sure), ["doc_id", "_row"]).dropDuplicates(["doc_id"])
            given[other].append(written(
                sure.select("doc_id", "_label", *FEATURES), f"{folder}/passed-{turn}-{other}"))
    if len(set(truth)) < 2:
        weights = dict.fromkeys(PARTS, 1.0)
        return Classifier(views, weights, -math.log(prior / (1 - prior))), pool
    odds = {
        name: sum(view.slopes[p] * m for p, m in margins[name].items()) + view.offset
        for name, view in views.items()
    }
    return Classifier(views, *_line(odds, truth, prior)), pool


def _margins(held: DataFrame, models: dict[str, LogisticRegressionModel]) -> dict[str, np.ndarray]:
    """Each model's margins of the held-out documents, by doc_id."""
    rows = held
    for part, model in models.items():
        rows = _raw(rows, model, part)
    found = rows.orderBy("doc_id").select(*[margin(f"{p}_raw").alias(p) for p in models]).collect()
    return {p: np.array([r[p] for r in found]) for p in models}


def _sure(pool: DataFrame, views: dict[str, View], known: DataFrame) -> DataFrame:
    """(doc_id, _row, chance by each view) of the unlabelled documents that a view is sure of.

    Of several rows with one doc_id one is taken.
    """
    rows = _with_odds(pool.where("doc_id is not null"), views, ["doc_id", "_row"])
    rows = rows.select("doc_id", "_row", *[chance(F.col(v)).alias(v) for v in PARTS])
    sure = F.lit(False)
    for view in PARTS:
        sure = sure | (F.col(view) >= SURE) | (F.col(view) <= 1 - SURE)
    rows = having(rows.where(sure), known, "doc_id", "left_anti")
    one = rows.groupBy("doc_id").agg(F.min(F.struct("_row", *PARTS)).alias("one"))
    return one.select("doc_id", "one.*")


def _surest(scored: DataFrame, prior: float) -> DataFrame:
    """The surest documents of each label, in the proportion of the labels. scored: doc_id, p."""
    good, bad = (max(1, round(PASSED_ON * x)) for x in (prior, 1 - prior))
    best = scored.where(F.col("p") >= SURE).orderBy(F.desc("p"), "doc_id").limit(good)
    worst = scored.where(F.col("p") <= 1 - SURE).orderBy("p", "doc_id").limit(bad)
    return best.select("doc_id", F.lit(1.0).alias("_label")).unionAll(
        worst.select("doc_id", F.lit(0.0).alias("_label"))
    )


def _raw(rows: DataFrame, model: LogisticRegressionModel, part: str) -> DataFrame:
    model = model.copy().setRawPredictionCol(f"{part}_raw").setProbabilityCol("")
    return model.setPredictionCol("").transform(rows)


def _with_odds(rows: DataFrame, views: dict[str, View], kept: list[str]) -> DataFrame:
    """The kept columns and each view's log odds, under its name."""
    odds = []
    for name, (models, slopes, offset) in views.items():
        total = F.lit(offset)
        for part, model in models.items():
            rows = _raw(rows, model, part)
            total = total + slopes[part] * margin(f"{part}_raw")
        odds.append(total.alias(name))
    return rows.select(*kept, *odds)


def _line(
    columns: dict[str, np.ndarray], truth: np.ndarray, prior: float
) -> tuple[dict[str, float], float]:
    """Slopes and offset that turn the columns into log odds of truth, as Platt scaling does.

    A column that says nothing, or the opposite, has no slope, and the others are fitted without
    it. Without two kinds of truth the columns' mean stands as it is.
    """
    if len(set(truth)) < 2:
        return dict.fromkeys(columns, 1.0 / len(columns)), 0.0
    useful = [name for name, values in columns.items() if values.std() > 0]
    while useful:
        slopes, offset = _fitted(np.stack([columns[c] for c in useful], axis=1), truth)
        if slopes.min() > 0:
            return dict.fromkeys(columns, 0.0) | dict(zip(useful, slopes.tolist())), offset
        useful.pop(int(slopes.argmin()))
    return dict.fromkeys(columns, 0.0), math.log(prior / (1 - prior))


def _fitted(values: np.ndarray, truth: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on few columns, by Newton's method on their standard scores."""
    middle, spread = values.mean(axis=0), values.std(axis=0)
    x = np.column_stack([(values - middle) / spread, np.ones(len(values))])
    ridge = np.diag([CALIBRATION] * values.shape[1] + [0.0])
    w = np.zeros(x.shape[1])
    for _ in range(NEWTON_STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - truth) / len(x) + ridge @ w
        bend = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x / len(x) + ridge
        step = np.linalg.solve(bend, slope)
        w -= step * min(1.0, 5.0 / max(1e-12, float(np.abs(step).max())))
    slopes = w[:-1] / spread
    return slopes, float(w[-1] - slopes @ middle)


# ---- scoring ---------------------------------------------------------------------------


def chance(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def _with_scores(features: DataFrame, classifier: Classifier) -> DataFrame:
    """Scores beside doc_id and the columns whose names begin with an underscore."""
    kept = [c for c in features.columns if c.startswith("_") or c == "doc_id"]
    rows = _with_odds(features, classifier.views, kept)
    weights = classifier.weights
    joint = weights["text"] * F.col("text") + weights["page"] * F.col("page") + classifier.offset
    return rows.select(
        *kept, chance(F.col("text")).alias("text_score"), chance(F.col("page")).alias("page_score"),
        chance(joint).alias("score"),
    )


def score(docs: DataFrame, classifier: Classifier | None, threshold: float = 0.5) -> DataFrame:
    """Per row of docs (doc_id, text, source, lang, n_chars): both views' and the joint probability.

    (doc_id, text_score, page_score, score, kept). score adds up the views' calibrated log odds
    with the weights that fit held-out labels. A document is kept from the threshold on.

    Defined cases: NULL and empty texts and NULL metadata are scored as such. Rows are judged one
    by one, so equal rows give equal rows; a NULL doc_id is kept as such. Without a classifier
    scores are NULL and all is kept. No rows give no rows. Other columns are not read.
    """
    rows = docs.select("doc_id", "text", "source", "lang", "n_chars")
    if classifier is None:
        none = F.lit(None).cast("double")
        return rows.select("doc_id", *[none.alias(c) for c in ("text_score", "page_score", "score")],
                           F.lit(True).alias("kept"))
    return _with_scores(with_features(rows), classifier).withColumn("kept", F.col("score") >= threshold)


def train_and_score(
    docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, threshold: float = 0.5
) -> DataFrame:
    """score(docs, train(docs, labels)), from the features that training has written for every row."""
    classifier, features = _trained(docs, labels, rounds)
    if classifier is None or features is None:
        return score(docs, classifier, threshold)
    rows = _with_scores(features.drop("_row"), classifier)
    return rows.withColumn("kept", F.col("score") >= threshold)


def keep_good(docs: DataFrame, classifier: Classifier | None, threshold: float = 0.5) -> DataFrame:
    """The rows of docs that score keeps, whole and in one pass; all of them without a classifier."""
    if classifier is None:
        return docs
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_document"),
        "doc_id", "text", "source", "lang", "n_chars",
    )
    good = _with_scores(with_features(rows), classifier).where(F.col("score") >= threshold)
    return good.select("_document.*")
