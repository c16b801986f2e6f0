"""Model training, prediction, batch scoring and persistence on Spark ML.

A trained model is a ``PipelineModel`` (the estimator over a feature vector) plus
the class values of a classification label, so predictions come back in the
label's own values. Training, prediction and scoring are distributed by
Spark ML; the driver only sees the (bounded) list of class values."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import qcol
from tidemark.operators import metrics as M
from tidemark.operators.boosting import fit_softmax_boosting
from tidemark.session import scratch_path
from tidemark.sources import files
from tidemark.sources.readers import nan_to_null

MODEL_TYPES = ("random_forest", "gradient_boosting", "linear")
DEFAULT_N_ESTIMATORS = 100
DEFAULT_RF_MAX_DEPTH = 30     # the deepest Spark ML allows: there, no depth means unlimited
DEFAULT_GBT_MAX_DEPTH = 3
DEFAULT_LEARNING_RATE = 0.1
DEFAULT_C = 1.0
#: Rows of a partition that is read in every pass of a fit: what a task reads does not follow the table's size.
PARTITION_ROWS = 1 << 18
_LABEL_IDX = "_label_idx"
_FEATURES = "_features"


def trainer_config(config: dict | None) -> dict:
    """Flat ``{model_type, task_type, model_params, ...}`` or nested under
    ``trainer`` (both occur in published configs)."""
    config = dict(config or {})
    if isinstance(config.get("trainer"), dict):
        merged = dict(config)
        merged.update(config["trainer"])
        return merged
    return config


def evaluator_config(config: dict | None) -> dict:
    config = dict(config or {})
    if isinstance(config.get("evaluator"), dict):
        merged = dict(config)
        merged.update(config["evaluator"])
        merged.setdefault("task_type", trainer_config(config).get("task_type", "classification"))
        return merged
    return config


@dataclass
class TrainedModel:
    model: PipelineModel
    features: list[str]
    label: str
    task_type: str
    model_type: str
    classes: list = field(default_factory=list)   # label values in index order


# Accepted hyperparameters per family. The last group only steers threads and
# logging in single-process libraries and has no meaning on a cluster.
_TREE_PARAMS = {"n_estimators", "max_depth", "min_samples_leaf", "max_features", "random_state"}
_PARAMS = {"random_forest": _TREE_PARAMS, "gradient_boosting": _TREE_PARAMS | {"learning_rate", "subsample"},
           "linear": {"C", "max_iter", "tol", "penalty", "l1_ratio", "fit_intercept", "random_state"}}
_NO_EFFECT = {"n_jobs", "verbose"}


class SoftmaxBoosting:
    """Boosting for more than two classes with the estimator call of the others."""

    def __init__(self, n_classes: int, **settings):
        self.n_classes, self.settings = n_classes, settings

    def fit(self, df: DataFrame) -> PipelineModel:
        return fit_softmax_boosting(df, self.n_classes, **self.settings)


def _feature_subset(value) -> str:
    """The share or number of features a split looks at, as Spark ML spells it."""
    if value is None:
        return "all"
    return str(value)  # sqrt, log2, a share in (0, 1] or a number


def _estimator(model_type: str, task_type: str, params: dict, seed: int, n_rows: int, n_classes: int):
    p = {k: v for k, v in (params or {}).items() if k not in _NO_EFFECT}
    if model_type not in MODEL_TYPES:
        raise ValueError(f"model type {model_type!r} is not one of {', '.join(MODEL_TYPES)}")
    unknown = sorted(set(p) - _PARAMS[model_type])
    if unknown:
        raise ValueError(f"{model_type} has no hyperparameter {', '.join(unknown)}")
    seed = int(p.pop("random_state", None) or seed)
    n_est = int(p.get("n_estimators", DEFAULT_N_ESTIMATORS))
    cls = task_type == "classification"
    common = dict(featuresCol=_FEATURES, labelCol=_LABEL_IDX)
    if model_type != "linear":
        depth = DEFAULT_RF_MAX_DEPTH if model_type == "random_forest" else DEFAULT_GBT_MAX_DEPTH
        common |= dict(maxDepth=int(p.get("max_depth") or depth), seed=seed,
                       minInstancesPerNode=int(p.get("min_samples_leaf", 1)))
        if "max_features" in p:
            common["featureSubsetStrategy"] = _feature_subset(p["max_features"])
    if model_type == "random_forest":
        return (RandomForestClassifier if cls else RandomForestRegressor)(numTrees=n_est, **common)
    if model_type == "gradient_boosting" and cls and n_classes > 2:
        return SoftmaxBoosting(n_classes, features=_FEATURES, label=_LABEL_IDX, rounds=n_est, step=float(p.get("learning_rate", DEFAULT_LEARNING_RATE)),
                               depth=common["maxDepth"], min_rows=common["minInstancesPerNode"],
                               subset=common.get("featureSubsetStrategy", "all"), sample=float(p.get("subsample", 1.0)), seed=seed)
    if model_type == "gradient_boosting":
        kw = dict(maxIter=n_est, stepSize=float(p.get("learning_rate", DEFAULT_LEARNING_RATE)),
                  subsamplingRate=float(p.get("subsample", 1.0)), **common)
        if not cls:
            return GBTRegressor(**kw)
        return GBTClassifier(**kw)
    intercept = bool(p.get("fit_intercept", True))
    if not cls:
        return LinearRegression(regParam=0.0, solver="normal", fitIntercept=intercept, **common)
    penalty = p.get("penalty", "l2")
    mixing = {None: 0.0, "none": 0.0, "l2": 0.0, "l1": 1.0, "elasticnet": float(p.get("l1_ratio") or 0.0)}
    if penalty not in mixing:
        raise ValueError(f"linear has no penalty {penalty!r}")
    strength = 0.0 if penalty in (None, "none") else 1.0 / (float(p.get("C", DEFAULT_C)) * max(n_rows, 1))
    return LogisticRegression(regParam=strength, elasticNetParam=mixing[penalty], standardization=False,
                              fitIntercept=intercept, tol=float(p.get("tol", 1e-6)),
                              maxIter=int(p.get("max_iter", 100)), **common)


def _class_values(df: DataFrame, label: str) -> list:
    """The sorted class values; a model holds them all, so they are collected."""
    vals = df.select(qcol(label).alias("v")).where(F.col("v").isNotNull()).distinct().collect()
    return sorted(r["v"] for r in vals)


def balanced(df: DataFrame) -> DataFrame:
    """Round-robin over the session's shuffle partitions, at least its parallelism
    and at most PARTITION_ROWS rows a partition, about (the rows are counted)."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")),
                              -(-df.count() // PARTITION_ROWS)))


def _is_array_input(df: DataFrame, features: list[str]) -> bool:
    return len(features) == 1 and isinstance(df.schema[features[0]].dataType, T.ArrayType)


def _index_label(df: DataFrame, label: str, classes: list) -> DataFrame:
    """The class's place in ``classes`` as _LABEL_IDX, by a join with the class
    list. The list is always broadcast: a shuffle by the class would leave the
    fit one partition a class."""
    kind = df.schema[label].dataType
    schema = T.StructType([T.StructField("_class", kind), T.StructField(_LABEL_IDX, T.DoubleType())])
    codes = df.sparkSession.createDataFrame([(v, float(i)) for i, v in enumerate(classes)], schema)
    return df.join(F.broadcast(codes), qcol(label) == F.col("_class"), "left").drop("_class")


def _vectors(df: DataFrame, features: list[str]) -> DataFrame:
    """``df`` with the feature vector _FEATURES; a NULL or NaN feature is an error."""
    if _is_array_input(df, features):
        # One array<number> column (e.g. an embedding) is the vector itself.
        return df.withColumn(_FEATURES, array_to_vector(qcol(features[0])))
    names = [f"_f{i}" for i in range(len(features))]  # names free of dots for the assembler
    out = df.withColumns({n: qcol(f).cast("double") for n, f in zip(names, features, strict=True)})
    return VectorAssembler(inputCols=names, outputCol=_FEATURES, handleInvalid="error").transform(out).drop(*names)


class ModelTrainer:
    """``ModelTrainer(config).train(df, label)``; config keys: model_type,
    task_type, model_params, random_state (flat or under ``trainer``)."""

    def __init__(self, config: dict | None = None):
        cfg = trainer_config(config)
        self.config = cfg
        self.model_type = cfg.get("model_type", "random_forest")
        self.task_type = cfg.get("task_type", "classification")
        self.model_params = dict(cfg.get("model_params", {}) or {})
        self.random_state = int(cfg.get("random_state", 42))
        self.trained: TrainedModel | None = None
        if self.model_type not in MODEL_TYPES:
            raise ValueError(f"model type {self.model_type!r} is not one of {', '.join(MODEL_TYPES)}")

    def train(self, df: DataFrame, label: str, features: list[str] | None = None,
              balance: bool = True) -> TrainedModel:
        """Fit on ``df``. With ``balance`` (default) the input is spread
        round-robin and persisted for the fit; pass False when the caller
        already holds a balanced, persisted table."""
        features = list(features or [c for c in df.columns if c != label])
        cls = self.task_type == "classification"
        df = nan_to_null(df.select(*[qcol(c) for c in features], qcol(label)))
        # Spark ML fits pass over their input many times with its partitioning
        # as is (and the class list is read first): one round-robin shuffle
        # gives every pass balanced tasks, and the copy is kept for the fit
        # (lost blocks are recomputed from lineage).
        if balance:
            df = balanced(df).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            classes = _class_values(df, label) if cls else []
            data = _index_label(df, label, classes) if cls else df.withColumn(
                _LABEL_IDX, qcol(label).cast("double"))
            n_rows = data.count() if (self.model_type == "linear" and cls) else 0
            est = _estimator(self.model_type, self.task_type, self.model_params, self.random_state,
                             n_rows, len(classes))
            rows = _vectors(data, features)
            model = est.fit(rows) if isinstance(est, SoftmaxBoosting) else Pipeline(stages=[est]).fit(rows)
        finally:
            if balance:
                df.unpersist()
        self.trained = TrainedModel(model, features, label, self.task_type, self.model_type, classes)
        return self.trained

    def save_model(self, path: str) -> str:
        if self.trained is None:
            raise ValueError("nothing to save: train a model first")
        return save_model(self.trained, path)


def predict(trained: TrainedModel, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Input columns (or ``keep``) + ``prediction`` in the label's values +
    ``probability`` array<double> (NULL for a regression)."""
    if trained is None:
        raise ValueError("no trained model to predict with")
    keep = list(df.columns if keep is None else keep)
    out = trained.model.transform(_vectors(df, trained.features))
    if trained.task_type == "classification":
        classes = F.array(*[F.lit(v) for v in trained.classes])
        pred = F.element_at(classes, F.col("prediction").cast("int") + 1)
    else:
        pred = F.col("prediction")
    kind = out.schema["probability"].dataType if "probability" in out.columns and trained.task_type == "classification" else None
    if kind is None:
        prob = F.lit(None).cast("array<double>")
    else:
        prob = F.col("probability") if isinstance(kind, T.ArrayType) else vector_to_array(F.col("probability"))
    return out.select(*[qcol(c) for c in keep], pred.alias("prediction"), prob.alias("probability"))


def evaluate(trained: TrainedModel, df: DataFrame, metric_names=None) -> DataFrame:
    """(metric, value) of the model on ``df`` (which holds the label)."""
    scored = predict(trained, df, keep=[trained.label])
    return M.evaluate(scored, trained.task_type, label=trained.label, prediction="prediction",
                      metrics=metric_names)


def score_batch(trained: TrainedModel, df: DataFrame, model_name: str, model_version: str | None = None,
                keep: list[str] | None = None) -> DataFrame:
    """Batch scoring: predictions, probabilities, model name / version and
    the batch size on every row. The batch is counted once, so hand in a table
    (or a persisted result) rather than a long plan."""
    scored = predict(trained, df, keep=keep)
    return scored.withColumn("batch_size", F.lit(df.count()).cast("long")).withColumn("model_name", F.lit(model_name)) \
        .withColumn("model_version", F.lit(model_version).cast("string"))


def save_model(trained: TrainedModel, path: str) -> str:
    """``<path>/model`` (PipelineModel) and ``<path>/meta`` (one JSON row)."""
    trained.model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    meta = json.dumps({"features": trained.features, "label": trained.label,
                       "task_type": trained.task_type, "model_type": trained.model_type,
                       "classes": trained.classes}, default=str)
    spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")
    return path


def load_model(spark: SparkSession, path: str) -> TrainedModel:
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    return TrainedModel(PipelineModel.load(f"{path}/model"), meta["features"], meta["label"],
                        meta["task_type"], meta["model_type"], meta["classes"])


def feature_importances(trained: TrainedModel) -> DataFrame:
    """(feature, importance) of a tree model (random forest or binary
    boosting); other models have none and give an error."""
    est = trained.model.stages[-1]
    if not hasattr(est, "featureImportances"):
        raise ValueError(f"{trained.model_type} model has no feature importances")
    imp = est.featureImportances.toArray().tolist()
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(list(zip(trained.features, [float(v) for v in imp])),
                                 "feature string, importance double")


def load_registered_model(spark: SparkSession, model_versions: DataFrame, name: str, model_root: str,
                          stage: str | None = None) -> tuple[TrainedModel, dict]:
    """Load the newest version of ``name`` (optionally in one stage) saved
    under ``<model_root>/<name>/<version>``; a missing model is an error."""
    from tidemark.operators.runs import latest_version
    info = latest_version(model_versions, name, stage)
    if info is None:
        raise ValueError(f"No registered version of model {name!r}" + (f" in stage {stage!r}" if stage else ""))
    return load_model(spark, f"{model_root}/{name}/{info['version']}"), info


def newest_saved_model(spark: SparkSession, model_root: str, name: str | None = None) -> tuple[TrainedModel, dict]:
    """The model saved last under ``<model_root>/<name>/<version>`` (any name
    unless given), found by its files alone: no version table is read. A model
    counts from the commit marker of ``meta``, which ``save_model`` writes last,
    so one that is half written is passed over. Equal times: the larger version,
    then the larger name. No saved model is an error."""
    found = []
    names = [n for n in files.names(spark, model_root) if n[0] not in "_."] if name is None else [name]
    for model in names:
        for version in files.names(spark, f"{model_root}/{model}"):
            saved = files.modified(spark, f"{model_root}/{model}/{version}/meta/_SUCCESS")
            if saved is not None:
                found.append((saved, int(version) if version.isdigit() else -1, model, version))
    if not found:
        raise ValueError(f"no saved model {'' if name is None else repr(name) + ' '}under {model_root}")
    saved, _, model, version = max(found)
    path = f"{model_root}/{model}/{version}"
    return load_model(spark, path), {"name": model, "version": version, "path": path, "saved_ms": saved}


@dataclass
class CrossValidation:
    predictions: DataFrame  # kept columns, label, fold, prediction, probability: one row a row with a fold
    metrics: DataFrame      # (fold, metric, value)


def cross_validate(config: dict, df: DataFrame, label: str, features: list[str] | None = None, fold_col: str = "fold",
                   keep: list[str] | None = None, metrics: list[str] | None = None) -> CrossValidation:
    """Out-of-fold predictions and metrics: for each value of ``fold_col`` (see
    ``split.assign_folds``) a model is trained on the rows of the other folds and
    predicts this fold's rows. The table is written once, balanced, and feeds all
    fits; each fold's predictions are written before the next fit begins. Rows
    without a fold or a label take no part. One fold alone is an error: nothing
    would be left to train on."""
    spark = df.sparkSession
    features = list(features or [c for c in df.columns if c not in (label, fold_col)])
    kept = list(dict.fromkeys([*(keep or []), label, fold_col]))
    path = scratch_path(spark, "folds")
    rows = df.select(*[qcol(c) for c in dict.fromkeys([*features, *kept])])
    balanced(rows.where(qcol(fold_col).isNotNull() & qcol(label).isNotNull())).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    folds = sorted(r[0] for r in rows.select(qcol(fold_col)).distinct().collect())  # one row a fold
    if len(folds) < 2:
        raise ValueError(f"{fold_col} names {len(folds)} folds; at least two are needed")
    parts, scores = [], []
    for i, fold in enumerate(folds):
        own = qcol(fold_col) == F.lit(fold)
        trained = ModelTrainer(config).train(rows.where(~own).select(*[qcol(c) for c in features], qcol(label)), label, features)
        predict(trained, rows.where(own), keep=kept).write.parquet(f"{path}/{i}")
        parts.append(spark.read.parquet(f"{path}/{i}"))
        scores.append(M.evaluate(parts[-1], trained.task_type, label=label, prediction="prediction", metrics=metrics)
                      .select(F.lit(fold).alias("fold"), "metric", "value"))
    return CrossValidation(reduce(DataFrame.unionByName, parts), reduce(DataFrame.unionByName, scores))


def request_frame(spark: SparkSession, trained: TrainedModel, features) -> DataFrame:
    """A scoring request as rows: a list of feature vectors gives one row
    each, in the model's feature order; a dict name -> value gives one row,
    matched to the model's features by name (a missing name is an error)."""
    names = trained.features
    if isinstance(features, dict):
        missing = [n for n in names if n not in features]
        if missing:
            raise ValueError(f"request lacks features {missing}")
        rows = [tuple(float(features[n]) for n in names)]
    else:
        rows = [tuple(float(v) for v in vec) for vec in features]
        bad = [len(r) for r in rows if len(r) != len(names)]
        if bad:
            raise ValueError(f"expected {len(names)} features per vector")
    return spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names))


def score_request(spark: SparkSession, trained: TrainedModel, features, model_name: str,
                  model_version: str | None = None) -> DataFrame:
    """Batch scoring of a request payload (see ``request_frame``)."""
    return score_batch(trained, request_frame(spark, trained, features), model_name, model_version)
