"""Training jobs: split, folds, fit, cross-validate, predict, sweep."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from functools import reduce
from typing import Any

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions.scores import split_hash
from foliospark.operators import calibrate, evaluate, features, forest, linear, vocabulary
from foliospark.plans.ordering import join_null_safe, running_totals
from foliospark.plans.scratch import written

RANDOM_FOREST = "RandomForestClassifier"
SVM = "SVM"
LOGISTIC = "LogisticRegression"

# Training defaults per algorithm. Solvers stop by their tolerance; the
# limits of iterations are there for fits that never would; a result says which it was.
# The SVM's subgradient rarely reaches its tolerance, and each iteration is a pass over
# all rows.
DEFAULTS: dict[str, dict[str, Any]] = {
    RANDOM_FOREST: {
        "n_estimators": 100, "max_depth": 10, "min_samples_leaf": 2,
        "max_features": "sqrt", "bootstrap": True,
    },
    SVM: {"kernel": "rbf", "C": 1.0, "max_iter": 100},
    LOGISTIC: {"penalty": "l2", "C": 1.0, "max_iter": 1000, "solver": "liblinear"},
}

# Stopping tolerances of the linear solvers.
SVM_TOLERANCE = 1e-3
LOGISTIC_TOLERANCE = 1e-4

# The seventeen configurations of the sweep as
# (name, algorithm, parameters, vocabulary size, n-gram range).
SWEEP = [
    ("RF_baseline", RANDOM_FOREST, {"n_estimators": 100, "max_depth": 10}, 5000, (1, 2)),
    ("RF_more_trees", RANDOM_FOREST, {"n_estimators": 200, "max_depth": 10}, 5000, (1, 2)),
    ("RF_deeper", RANDOM_FOREST, {"n_estimators": 100, "max_depth": 20}, 5000, (1, 2)),
    ("RF_conservative", RANDOM_FOREST, {"n_estimators": 150, "max_depth": 7}, 3000, (1, 2)),
    ("RF_more_features", RANDOM_FOREST, {"n_estimators": 100, "max_depth": 10}, 10000, (1, 3)),
    ("SVM_baseline", SVM, {"kernel": "rbf", "C": 1.0}, 5000, (1, 2)),
    ("SVM_linear", SVM, {"kernel": "linear", "C": 1.0}, 5000, (1, 2)),
    ("SVM_high_C", SVM, {"kernel": "rbf", "C": 10.0}, 5000, (1, 2)),
    ("SVM_low_C", SVM, {"kernel": "rbf", "C": 0.1}, 3000, (1, 2)),
    ("SVM_poly", SVM, {"kernel": "poly", "C": 1.0}, 3000, (1, 2)),
    ("LR_baseline", LOGISTIC, {"penalty": "l2", "C": 1.0, "solver": "liblinear"}, 5000, (1, 2)),
    ("LR_l1_penalty", LOGISTIC, {"penalty": "l1", "C": 1.0, "solver": "liblinear"}, 5000, (1, 2)),
    ("LR_high_reg", LOGISTIC, {"penalty": "l2", "C": 0.1, "solver": "liblinear"}, 3000, (1, 2)),
    ("LR_low_reg", LOGISTIC, {"penalty": "l2", "C": 10.0, "solver": "liblinear"}, 7000, (1, 2)),
    ("LR_lbfgs", LOGISTIC, {"penalty": "l2", "C": 1.0, "solver": "lbfgs"}, 5000, (1, 2)),
    ("RF_unigrams_only", RANDOM_FOREST, {"n_estimators": 100, "max_depth": 10}, 5000, (1, 1)),
    ("LR_extended_ngrams", LOGISTIC, {"penalty": "l2", "C": 1.0, "solver": "liblinear"}, 8000, (1, 4)),
]

#: N-gram ranges of a sweep whose vectors are kept at the same time.
RANGES_AT_ONCE = 2

RESULT_SCHEMA = (
    "experiment_name string, algorithm string, status string, training_time double, "
    "test_accuracy double, test_precision double, test_recall double, test_f1_score double, "
    "test_roc_auc double, cv_mean_score double, cv_std_score double, training_samples bigint, "
    "test_samples bigint, features int, classes int, converged boolean, error string"
)


@dataclass(frozen=True)
class TrainConfig:
    """One configuration. The parameter map belongs to this configuration alone."""

    name: str
    algorithm: str
    params: Mapping[str, Any] = field(default_factory=dict)
    max_features: int = 5000
    ngram_range: tuple[int, int] = (1, 2)

    def merged(self) -> dict[str, Any]:
        if self.algorithm not in DEFAULTS:
            raise ValueError(f"unsupported algorithm: {self.algorithm}")
        return {**DEFAULTS[self.algorithm], **self.params}


def sweep_configs() -> list[TrainConfig]:
    return [TrainConfig(n, a, dict(p), size, grams) for n, a, p, size, grams in SWEEP]


@dataclass(frozen=True)
class Inputs:
    """Which columns of a table are the key, the target and the inputs.

    The target may not be among the inputs.
    """

    id_column: str
    target: str
    text: Sequence[str]
    numeric: Sequence[str] = ()
    categorical: Sequence[str] = ()

    def __post_init__(self):
        if self.target in {*self.text, *self.numeric, *self.categorical}:
            raise ValueError(f"target {self.target} is also an input")


def train_test_split(
    df: DataFrame, id_column: str, test_size: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the key: the same rows whatever the partitioning."""
    is_train = split_hash(id_column, seed) < 1 - test_size
    return df.where(is_train), df.where(~is_train)


def fold_numbers(
    df: DataFrame, id_column: str, label: str, folds: int = 5, seed: int = 42
) -> DataFrame:
    """Rows `(id, fold)`: within each class, rows are dealt out in hash order.

    Rows without a class are dealt out as a class of their own. Keys are unique.

    The rank inside a class comes from running totals over hash ranges, so a
    class with a third of all rows is ranked by many tasks.
    """
    hashed = df.select(id_column, label, split_hash(id_column, seed).alias("_h"))
    ranked = running_totals(
        hashed, ["_h", id_column], {"_rank": F.lit(1).cast("bigint")}, [label]
    )
    return ranked.select(id_column, F.pmod(F.col("_rank") - 1, F.lit(folds)).cast("int").alias("fold"))


def with_folds(
    df: DataFrame, id_column: str, label: str, folds: int = 5, seed: int = 42
) -> DataFrame:
    """Add the fold number of `fold_numbers`."""
    return join_null_safe(df, fold_numbers(df, id_column, label, folds, seed), [id_column])


def make_classifier(algorithm: str, params: Mapping[str, Any], n_rows: int, seed: int = 42) -> Estimator:
    """The MLlib estimator of a configuration.

    Strength C of a penalised fit over n rows is `1 / (C * n)` in MLlib's terms,
    applied to standardised features: they mix unit-length text with raw counts,
    and the solvers need many times more passes without it.
    Only the linear kernel has a distributed solver.
    """
    common = {"featuresCol": "features", "labelCol": "label"}
    if algorithm == RANDOM_FOREST:
        return RandomForestClassifier(
            numTrees=params["n_estimators"],
            maxDepth=params["max_depth"],
            minInstancesPerNode=params["min_samples_leaf"],
            featureSubsetStrategy=str(params["max_features"]),
            bootstrap=params["bootstrap"],
            seed=seed,
            maxMemoryInMB=512,
            **common,
        )
    strength = 1.0 / (params["C"] * n_rows) if algorithm in (SVM, LOGISTIC) else None
    if algorithm == SVM:
        if params["kernel"] != "linear":
            raise ValueError(f"no distributed solver for the {params['kernel']} kernel")
        return OneVsRest(
            classifier=LinearSVC(regParam=strength, maxIter=params["max_iter"], tol=SVM_TOLERANCE),
            parallelism=4,
            **common,
        )
    if algorithm == LOGISTIC:
        binary = LogisticRegression(
            regParam=strength,
            elasticNetParam=1.0 if params["penalty"] == "l1" else 0.0,
            maxIter=params["max_iter"],
            tol=LOGISTIC_TOLERANCE,
            **common,
        )
        if params["solver"] == "liblinear":
            return OneVsRest(classifier=binary, parallelism=4, **common)
        return binary.setFamily("multinomial")
    raise ValueError(f"unsupported algorithm: {algorithm}")


def predict(
    model: Model, df: DataFrame, sigmoids: Sequence[tuple[float, float]] | None = None
) -> DataFrame:
    """Add `prediction` and, where the model has them, class probabilities.

    One-vs-rest logistic margins become probabilities by the logistic function, other
    margins by their calibrated `sigmoids`, scaled to sum to one.
    """
    scored = model.transform(df)
    if "probability" in scored.columns:
        return scored.withColumn("probability", vector_to_array("probability"))
    sub_models = getattr(model, "models", [])
    if sigmoids is None and sub_models and hasattr(sub_models[0], "setProbabilityCol"):
        sigmoids = [(1.0, 0.0)] * len(sub_models)
    if sigmoids is not None:
        return calibrate.with_probabilities(scored, vector_to_array("rawPrediction"), sigmoids)
    return scored


def converged(model: Model, max_iter: int | None) -> bool | None:
    """Whether every solver of the model stopped before its limit; none for models without one."""
    found = []
    for part in getattr(model, "models", [model]):
        if max_iter is None or not getattr(part, "hasSummary", False):
            return None
        summary = part.summary() if callable(part.summary) else part.summary
        found.append(summary.totalIterations < max_iter)
    return all(found)


def fold_accuracy(model: Model, df: DataFrame) -> float | None:
    """Share of right predictions; none for a fold without rows."""
    hits = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    return model.transform(df).agg(hits).first()[0]


class Pools:
    """Runs fits side by side, each in a scheduler pool of its own.

    Where the session schedules fairly (`spark.scheduler.mode` FAIR), a long fit does
    not hold up the short ones; else the pools have no effect.
    """

    def __init__(self, spark: SparkSession, threads: int = 8):
        self.spark = spark
        self.threads = ThreadPoolExecutor(threads)

    def submit(self, pool: str, run: Callable[..., Any], *args: Any) -> Future:
        def in_pool():
            self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
            return run(*args)

        return self.threads.submit(inheritable_thread_target(self.spark)(in_pool))

    def __enter__(self) -> "Pools":
        return self

    def __exit__(self, *_: Any) -> None:
        self.threads.shutdown(cancel_futures=True)


def fit_folds(
    pools: Pools, pool: str, train: DataFrame, estimator: Estimator, folds: int
) -> list[Future]:
    """The fits that leave out one fold each."""
    return [
        pools.submit(pool, estimator.fit, train.where(F.col("fold") != k)) for k in range(folds)
    ]


def cross_validate(train: DataFrame, estimator: Estimator, folds: int = 5) -> list[float]:
    """Accuracy on each held-out fold with rows; the folds are fitted side by side as Spark jobs."""
    with Pools(train.sparkSession, folds) as pools:
        models = [f.result() for f in fit_folds(pools, "folds", train, estimator, folds)]
    scores = [fold_accuracy(m, train.where(F.col("fold") == k)) for k, m in enumerate(models)]
    return [s for s in scores if s is not None]


def calibrated(train: DataFrame, models: Sequence[Model], classes: int) -> list[tuple[float, float]]:
    """Sigmoids of the classes from margins on the folds that each model has not seen."""
    parts = [
        m.transform(train.where(F.col("fold") == k)).select(
            "label", vector_to_array("rawPrediction").alias("margins")
        )
        for k, m in enumerate(models)
    ]
    return calibrate.fit_sigmoids(written(reduce(DataFrame.union, parts), "margins"), classes)


@dataclass
class Prepared:
    """Feature vectors of one (n-gram range, vocabulary size), kept for many fits."""

    train: DataFrame
    test: DataFrame
    names: list[str]
    classes: list[str]
    n_train: int
    n_test: int
    cached: list[DataFrame]
    chain: PipelineModel
    inputs: Inputs
    ngram_range: tuple[int, int]
    n_terms: int

    def release(self) -> None:
        for part in self.cached:
            part.unpersist()


@dataclass
class Split:
    """A labelled table in its two parts, with stored words and, for the training part, fold numbers: the same for all n-grams."""

    train: DataFrame
    test: DataFrame
    numbers: DataFrame
    encoder: Model
    others: list[str]


def split_words(
    df: DataFrame, inputs: Inputs, test_size: float = 0.2, folds: int = 5, seed: int = 42, stored: bool = False
) -> Split:
    """Encode the classes, cut the texts into words once and split. With `stored` the fold numbers are written, for several uses."""
    wanted = [inputs.id_column, inputs.target, *inputs.text, *inputs.numeric, *inputs.categorical]
    table = df.select(*dict.fromkeys(wanted)).where(F.col(inputs.target).isNotNull())
    encoder = features.fit_label_encoder(table, inputs.target).setHandleInvalid("error")
    others = list(dict.fromkeys([inputs.id_column, "label", *inputs.numeric, *inputs.categorical]))
    encoded = features.stored_grams(encoder.transform(table), others, inputs.text, words="_words").select(*others, "_words")
    train, test = train_test_split(encoded, inputs.id_column, test_size, seed)
    # numbered from the rows before they are counted, as the numbering reads them several times
    numbers = fold_numbers(features.numeric_features(train, inputs.numeric), inputs.id_column, "label", folds, seed)
    return Split(train, test, written(numbers, "folds") if stored else numbers, encoder, others)


def prepare_sizes(
    df: DataFrame,
    inputs: Inputs,
    sizes: Sequence[int],
    ngram_range: tuple[int, int] = (1, 2),
    test_size: float = 0.2,
    folds: int = 5,
    seed: int = 42,
    split: Split | None = None,
) -> dict[int, Prepared]:
    """Split, fit the vectoriser and the levels on the training part, assemble both parts.

    Texts are tokenised and counted once for all vocabulary sizes: a smaller vocabulary
    is the beginning of a larger one, so its counts are the beginning of the counts. A `split`
    of `split_words` serves several n-gram ranges.
    """
    split = split or split_words(df, inputs, test_size, folds, seed)
    train, test, encoder, others = split.train, split.test, split.encoder, split.others
    whole = features.TextVectorizer.fit(train, max_features=max(sizes), words="_words", ngram_range=ngram_range)
    lookups, columns, dummies = [], [whole.output, *inputs.numeric], []
    for c in inputs.categorical:
        lookup, vector, levels = features.fit_levels(train, c)
        lookups += lookup
        columns.append(vector)
        dummies += [f"{c}_{v}" for v in levels]
    assembler = VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep")
    to_counts = PipelineModel([whole.stages[0], *lookups])
    kept = [inputs.id_column, "label", F.col("_tf").alias("_all"), *columns[1:]]

    def counts(part: DataFrame) -> DataFrame:
        known = vocabulary.known_grams(part, whole.terms, "_words", ngram_range, others, whole.grams)
        return to_counts.transform(features.numeric_features(known, inputs.numeric)).select(*kept)

    folded = join_null_safe(counts(train), split.numbers, [inputs.id_column])
    counted = [part.persist(StorageLevel.MEMORY_AND_DISK) for part in (folded, counts(test))]
    out = {}
    for size in sorted(set(sizes)):
        vectorizer = whole.first(size)
        weigh = PipelineModel([*vectorizer.stages[1:], assembler])
        if len(vectorizer.terms) < len(whole.terms):
            cut = VectorSlicer(inputCol="_all", outputCol="_tf", indices=list(range(len(vectorizer.terms))))
            weigh = PipelineModel([cut, *weigh.stages])
            ready = counted
        else:
            ready = [part.withColumnRenamed("_all", "_tf") for part in counted]
        train_columns = [inputs.id_column, "label", "features", "fold"]
        cached = [
            weigh.transform(part).select(*columns_).persist(StorageLevel.MEMORY_AND_DISK)
            for part, columns_ in zip(ready, (train_columns, train_columns[:-1]))
        ]
        n_train, n_test = (part.count() for part in cached)
        out[size] = Prepared(
            train=cached[0],
            test=cached[1],
            names=[*vectorizer.terms, *inputs.numeric, *dummies],
            classes=list(encoder.labels),
            chain=PipelineModel([*vectorizer.stages, *lookups, assembler]),
            inputs=inputs,
            ngram_range=tuple(ngram_range),
            n_terms=len(vectorizer.terms),
            n_train=n_train,
            n_test=n_test,
            cached=cached,
        )
    for part in counted:
        part.unpersist()
    return out


def prepare(
    df: DataFrame,
    inputs: Inputs,
    max_features: int = 5000,
    ngram_range: tuple[int, int] = (1, 2),
    test_size: float = 0.2,
    folds: int = 5,
    seed: int = 42,
) -> Prepared:
    """`prepare_sizes` for one vocabulary size."""
    return prepare_sizes(df, inputs, [max_features], ngram_range, test_size, folds, seed)[max_features]


def forest_task(config: TrainConfig) -> forest.ForestTask:
    """The configuration for the forests that are grown together."""
    p = config.merged()
    return forest.ForestTask(
        config.name, p["n_estimators"], p["max_depth"], p["min_samples_leaf"], str(p["max_features"]), p["bootstrap"]
    )


def fit(prepared: Prepared, config: TrainConfig, seed: int = 42) -> Model:
    if config.algorithm == RANDOM_FOREST:
        rows = prepared.train.select("label", "fold", "features")
        (grown,) = forest.fit_many(rows, [forest_task(config)], len(prepared.classes), seed=seed)
        return forest.as_model(rows.sparkSession, grown, seed)
    estimator = make_classifier(config.algorithm, config.merged(), prepared.n_train, seed)
    return estimator.fit(prepared.train)


@dataclass
class Classifier:
    """A fitted model with all that leads from a table's columns to its class names."""

    chain: PipelineModel
    model: Model
    inputs: Inputs
    ngram_range: tuple[int, int]
    classes: list[str]
    sigmoids: list[tuple[float, float]] | None = None

    @classmethod
    def of(
        cls, prepared: Prepared, model: Model, sigmoids: list[tuple[float, float]] | None = None
    ) -> "Classifier":
        return cls(
            prepared.chain, model, prepared.inputs, prepared.ngram_range, prepared.classes, sigmoids
        )

    def predict(self, df: DataFrame) -> DataFrame:
        """New rows with `prediction`, `predicted_class` and, where there are any, probabilities."""
        grams = features.with_grams(df, self.inputs.text, self.ngram_range)
        ready = self.chain.transform(features.numeric_features(grams, self.inputs.numeric))
        names = F.array(*map(F.lit, self.classes))
        scored = predict(self.model, ready.select(*df.columns, "features"), self.sigmoids)
        return scored.withColumn("predicted_class", F.get(names, F.col("prediction").cast("int")))

    def save(self, path: str) -> None:
        PipelineModel([*self.chain.stages, self.model]).write().overwrite().save(f"{path}/model")
        about = {**asdict(self.inputs), "ngram_range": self.ngram_range, "classes": self.classes}
        about["sigmoids"] = self.sigmoids
        session = SparkSession.active()
        session.range(1).select(F.lit(json.dumps(about)).alias("value")).write.mode("overwrite").text(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Classifier":
        about = json.loads(spark.read.text(f"{path}/about").first()["value"])
        *chain, model = PipelineModel.load(f"{path}/model").stages
        ngram_range, classes = tuple(about.pop("ngram_range")), about.pop("classes")
        sigmoids = about.pop("sigmoids")
        return cls(PipelineModel(chain), model, Inputs(**about), ngram_range, classes, sigmoids)


def test_scores(predictions: DataFrame, classes: int) -> dict[str, float | None]:
    """Weighted scores and, with probabilities and more than two classes, the AUC."""
    scores = evaluate.weighted_scores(evaluate.confusion_matrix(predictions)).first().asDict()
    scores["roc_auc"] = None
    if classes > 2 and "probability" in predictions.columns:
        long = predictions.select("label", F.posexplode("probability").alias("class", "score")).select(
            "class", "score", (F.col("label") == F.col("class")).alias("is_class")
        )
        scores["roc_auc"] = evaluate.roc_auc_ovr(long).first()["roc_auc"]
    return scores


def run_config(
    prepared: Prepared, config: TrainConfig, folds: int = 5, seed: int = 42, pools: Pools | None = None
) -> dict[str, Any]:
    """Fit, cross-validate and score one configuration; the row of the results table."""
    if config.algorithm == RANDOM_FOREST:
        return run_forests(prepared, [config], folds, seed)[0]
    if pools is None:
        with Pools(prepared.train.sparkSession) as own:
            return run_config(prepared, config, folds, seed, own)
    start = time.monotonic()
    merged = config.merged()
    estimator = make_classifier(config.algorithm, merged, prepared.n_train, seed)
    whole = pools.submit(config.name, estimator.fit, prepared.train)
    models = [f.result() for f in fit_folds(pools, config.name, prepared.train, estimator, folds)]
    found = [fold_accuracy(m, prepared.train.where(F.col("fold") == k)) for k, m in enumerate(models)]
    fold_scores = [s for s in found if s is not None]
    k = len(prepared.classes)
    sigmoids = calibrated(prepared.train, models, k) if config.algorithm == SVM else None
    model = whole.result()
    scores = test_scores(predict(model, prepared.test, sigmoids), k)
    ended = converged(model, merged.get("max_iter"))
    return _result(prepared, config, time.monotonic() - start, scores, fold_scores, ended)


def run_forests(
    prepared: Prepared, configs: Sequence[TrainConfig], folds: int = 5, seed: int = 42
) -> list[dict[str, Any]]:
    """Result rows of forests over the same vectors, all grown in the same passes; the training time is that of all."""
    began, k = time.monotonic(), len(prepared.classes)
    rows = prepared.train.select("label", "fold", "features")
    grown = forest.fit_many(rows, [forest_task(c) for c in configs], k, folds, seed)
    fits = [grown[i : i + folds + 1] for i in range(0, len(grown), folds + 1)]

    def scored(part: DataFrame, name: str) -> DataFrame:
        """Rows `(label, fold, p0, p1, ...)`: the classes' probabilities by each configuration."""
        votes = forest.with_votes(part, fits)
        return written(votes.select("label", "fold", *[F.get("votes", F.lit(i)).alias(f"p{i}") for i in range(len(fits))]), name)

    def best(i: int) -> Column:
        return F.array_position(f"p{i}", F.array_max(f"p{i}")).cast("double") - 1

    unseen, tested = scored(rows.where(F.col("fold").between(0, folds - 1)), "unseen"), scored(prepared.test, "tested")
    hits = [F.avg((best(i) == F.col("label")).cast("double")).alias(f"h{i}") for i in range(len(fits))]
    by_fold = unseen.groupBy("fold").agg(*hits).orderBy("fold").collect()
    out = []
    for i, config in enumerate(configs):
        predicted = tested.select("label", best(i).alias("prediction"), F.col(f"p{i}").alias("probability"))
        fold_scores = [r[f"h{i}"] for r in by_fold]
        out.append(_result(prepared, config, time.monotonic() - began, test_scores(predicted, k), fold_scores, None))
    return out


_LOSSES = {"liblinear": linear.LOGISTIC, "lbfgs": linear.SOFTMAX}


def is_linear(config: TrainConfig) -> bool:
    return config.algorithm in (SVM, LOGISTIC)


def linear_task(config: TrainConfig, n_rows: int) -> linear.LinearTask:
    """The configuration for the solver that fits many at once.

    The machine's loss is the squared hinge, which has a gradient everywhere, so that
    its fit comes to an end.
    """
    p = config.merged()
    if config.algorithm == SVM and p["kernel"] != "linear":
        raise ValueError(f"no distributed solver for the {p['kernel']} kernel")
    loss = linear.HINGE if config.algorithm == SVM else _LOSSES[p["solver"]]
    strength = 1.0 / (p["C"] * max(n_rows, 1))
    return linear.LinearTask(config.name, loss, strength, p.get("penalty") == "l1", p["max_iter"])


def _with_prediction(scored: DataFrame, margins: Column, loss: str, sigmoids) -> DataFrame:
    """Rows `(label, prediction, probability)` from class margins."""
    best = F.array_position("_m", F.array_max("_m")) - 1
    placed = scored.select("label", margins.alias("_m")).withColumn("prediction", best.cast("double"))
    if loss == linear.SOFTMAX:
        shifted = placed.withColumn("_e", F.transform("_m", lambda m: F.exp(m - F.array_max("_m"))))
        total = F.aggregate("_e", F.lit(0.0), lambda a, e: a + e)
        return shifted.withColumn("probability", F.transform("_e", lambda e: e / total))
    return calibrate.with_probabilities(placed, F.col("_m"), sigmoids)


def run_linear(
    prepared: Prepared,
    configs: Sequence[TrainConfig],
    folds: int = 5,
    start: dict[tuple[str, int], np.ndarray] | None = None,
) -> tuple[list[dict[str, Any]], list[linear.LinearFit]]:
    """Result rows of linear configurations over the same vectors, all fits in the same passes.

    The training time of each is that of all. The machine's probabilities come from
    margins on rows that a fit has not seen.
    """
    began, k = time.monotonic(), len(prepared.classes)
    tasks = [linear_task(c, prepared.n_train) for c in configs]
    rows = prepared.train.select("label", "fold", "features")
    fits = linear.fit_many(rows, tasks, k, folds, start)
    whole = [f for f in fits if f.fold < 0]
    parts = [f for f in fits if f.fold >= 0]
    unseen = written(linear.with_margins(prepared.train, parts), "margins")
    own = [F.get("margins", F.col("fold") + i * folds) for i in range(len(tasks))]
    hits = [(F.array_position(m, F.array_max(m)) - 1 == F.col("label")).cast("double") for m in own]
    by_fold = unseen.groupBy("fold").agg(*[F.avg(h).alias(f"h{i}") for i, h in enumerate(hits)]).collect()
    tested = written(linear.with_margins(prepared.test, whole), "margins")
    out = []
    for i, (config, task) in enumerate(zip(configs, tasks)):
        sigmoids = [(1.0, 0.0)] * k
        if task.loss == linear.HINGE:
            sigmoids = calibrate.fit_sigmoids(unseen.select("label", own[i].alias("margins")), k)
        predicted = _with_prediction(tested, F.get("margins", F.lit(i)), task.loss, sigmoids)
        scores = test_scores(predicted, k)
        fold_scores = [r[f"h{i}"] for r in by_fold]
        out.append(
            _result(prepared, config, time.monotonic() - began, scores, fold_scores, whole[i].converged)
        )
    return out, fits


def _result(prepared: Prepared, config: TrainConfig, seconds: float, scores, fold_scores, ended) -> dict[str, Any]:
    counted = max(len(fold_scores), 1)
    mean = sum(fold_scores) / counted
    return {
        "experiment_name": config.name,
        "algorithm": config.algorithm,
        "status": "success",
        "training_time": seconds,
        "test_accuracy": scores["accuracy"],
        "test_precision": scores["precision"],
        "test_recall": scores["recall"],
        "test_f1_score": scores["f1_score"],
        "test_roc_auc": scores["roc_auc"],
        "cv_mean_score": mean,
        "cv_std_score": (sum((s - mean) ** 2 for s in fold_scores) / counted) ** 0.5,
        "training_samples": prepared.n_train,
        "test_samples": prepared.n_test,
        "features": len(prepared.names),
        "classes": len(prepared.classes),
        "converged": ended,
        "error": None,
    }


def penalty_path(
    prepared: Mapping[int, Prepared], configs: Sequence[TrainConfig], folds: int
) -> dict[str, dict[str, Any]]:
    """Result rows of linear configurations of one n-gram range, by name.

    Vocabularies follow one another from the smallest, and each fold's fits begin where
    those of the same loss and penalty ended on the smaller one.
    """
    rows, ends = {}, {}
    for size in sorted({c.max_features for c in configs}):
        members = [c for c in configs if c.max_features == size]
        terms = prepared[size].n_terms
        tasks = {c.name: linear_task(c, prepared[size].n_train) for c in members}
        start = {}
        for name, task in tasks.items():
            for fold in range(-1, folds):
                known = ends.get((task.loss, task.lasso, fold))
                if known is not None:
                    start[name, fold] = linear.extended(known[1], known[0], terms)
        found, fits = run_linear(prepared[size], members, folds, start)
        rows |= {r["experiment_name"]: r for r in found}
        ends |= {(f.task.loss, f.task.lasso, f.fold): (terms, f.weights) for f in fits}
    return rows


def _failed(config: TrainConfig, error: Exception) -> dict[str, Any]:
    return {
        "experiment_name": config.name,
        "algorithm": config.algorithm,
        "status": "failed",
        "error": str(error),
    }


def results_frame(spark: SparkSession, rows: Sequence[Mapping[str, Any]]) -> DataFrame:
    names = [part.split()[0] for part in RESULT_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], RESULT_SCHEMA)


def sweep(
    df: DataFrame,
    inputs: Inputs,
    configs: Sequence[TrainConfig] | None = None,
    folds: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Run every configuration and return one result row each, in the given order.

    Texts are cut into words and rows are split and dealt to folds once for all n-gram ranges;
    configurations of one range share its counts whatever their vocabulary sizes. Linear ones go through `penalty_path`, in which every pass over
    the rows serves all their fits; forests of one vocabulary are grown together beside it, in a
    scheduler pool of their own. The vectors of RANGES_AT_ONCE ranges are kept at a time. A
    configuration without a solver becomes a `failed` row and the sweep goes on; any other error ends it.
    """
    configs = sweep_configs() if configs is None else list(configs)
    rows: dict[int, dict[str, Any]] = {}
    groups: dict[tuple[int, int], list[int]] = {}
    for i, c in enumerate(configs):
        try:
            # a configuration without a solver fails before any features are built
            make_classifier(c.algorithm, c.merged(), 1, seed)
        except ValueError as error:  # a cluster that fails is no fault of a configuration
            rows[i] = _failed(c, error)
            continue
        groups.setdefault(tuple(c.ngram_range), []).append(i)
    spark = df.sparkSession
    in_thread = inheritable_thread_target(spark)

    def run_range(ngram_range: tuple[int, int], members: list[int], fits: Pools) -> dict[int, dict[str, Any]]:
        sizes = [configs[i].max_features for i in members]
        prepared = prepare_sizes(df, inputs, sizes, ngram_range, folds=folds, seed=seed, split=split)
        straight = [configs[i] for i in members if is_linear(configs[i])]
        by_size: dict[int, list[int]] = {}
        for i in members:
            if not is_linear(configs[i]):
                by_size.setdefault(configs[i].max_features, []).append(i)
        jobs = {
            size: fits.submit(f"forests {size}", run_forests, prepared[size], [configs[i] for i in own], folds, seed)
            for size, own in by_size.items()
        }
        found = penalty_path(prepared, straight, folds)
        out = {i: found[configs[i].name] for i in members if is_linear(configs[i])}
        for size, own in by_size.items():
            out |= dict(zip(own, jobs[size].result()))
        for part in prepared.values():
            part.release()
        return out

    split = split_words(df, inputs, folds=folds, seed=seed, stored=True) if len(groups) > 1 else None
    with Pools(spark) as fits, ThreadPoolExecutor(RANGES_AT_ONCE) as running:
        done = [running.submit(in_thread(run_range), r, m, fits) for r, m in groups.items()]
        for job in done:
            rows |= job.result()
    return results_frame(spark, [rows[i] for i in range(len(configs))])


def importances(spark: SparkSession, model: Model, names: Sequence[str]) -> DataFrame:
    """Rows `(feature, importance)` of a forest; as many as the model has features."""
    values = model.featureImportances.toArray()
    return spark.createDataFrame(
        [(n, float(v)) for n, v in zip(names, values)], "feature string, importance double"
    )


def top_features(importance: DataFrame, k: int = 20) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(k)
