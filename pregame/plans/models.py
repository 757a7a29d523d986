"""Classifiers, time-ordered model search, selection and persistence.

Preprocessing is fitted on the train split only and baked into the pipeline
as a ``SQLTransformer`` (exact medians for imputation, population standard
deviation for scaling -- ``ml.Imputer`` uses approximate quantiles and
``ml.StandardScaler`` the sample deviation, both different from the original
pipeline), so a fitted ``PipelineModel`` carries everything needed at
serving time and persists as one directory.
"""
from __future__ import annotations

import json
import random
import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier,
                                       LogisticRegression)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import columns as C
from ..operators import metrics, ordered

VEC = "features_vec"
# A fit makes hundreds of passes over its vectors, each with an aggregate of all bins
# per partition: fewer and larger partitions cost less time and less shuffle.  Beyond
# TASKS_PER_CORE the partitions grow, not their number, so the aggregates don't: a pass is
# then one wave of tasks.
ROWS_PER_TASK = 1 << 17
TASKS_PER_CORE = 1


def train_medians(train: DataFrame, cols: list[str]) -> DataFrame:
    """Exact median of every feature over the train rows -> (feature, median)."""
    q = ordered.exact_quantiles(train, cols, [0.5])
    return q.select(F.col("column").alias("feature"), F.col("value").alias("median"))


def _medians_dict(medians: DataFrame) -> dict[str, float]:
    # one number per feature reaches the driver (bounded by the feature count)
    return {r["feature"]: r["median"] for r in medians.collect()}


def standardization(train: DataFrame, cols: list[str], medians) -> DataFrame:
    """Mean and population std of each imputed feature -> (feature, mean, std)."""
    med = medians if isinstance(medians, dict) else _medians_dict(medians)
    imp = [F.coalesce(F.col(c).cast("double"), F.lit(med.get(c))) for c in cols]
    one = train.agg(*[x for c, e in zip(cols, imp) for x in (
        F.avg(e).alias(f"m__{c}"), F.stddev_pop(e).alias(f"s__{c}"))])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"m__{c}").alias("mean"), F.col(f"s__{c}").alias("std"))
        for c in cols])))


def _q(c: str) -> str:
    return f"`{c}`"


def preprocess_stage(cols: list[str], med: dict[str, float], scale: dict[str, tuple] | None) -> SQLTransformer:
    """Impute with train medians (and optionally standardise) as plain SQL."""
    exprs = []
    for c in cols:
        m = med.get(c)
        e = f"coalesce(CAST({_q(c)} AS DOUBLE), {repr(float(m)) if m is not None else 'NULL'})"
        if scale is not None:
            mean, std = scale[c]
            std = std if std else 1.0  # constant column: scale 1, like StandardScaler
            e = f"(({e}) - {mean!r}) / {std!r}"
        exprs.append(f"{e} AS {_q('z__' + c)}")
    return SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")


def _assembler(cols: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=[f"z__{c}" for c in cols], outputCol=VEC, handleInvalid="keep")


def fit_tasks(train: DataFrame) -> int:
    """Partitions of a fit: one per ROWS_PER_TASK, but on few rows as many as there are
    cores, while each has a quarter of that, and on many TASKS_PER_CORE."""
    rows, cores = train.count(), train.sparkSession.sparkContext.defaultParallelism
    return max(1, min(TASKS_PER_CORE * cores, -(-rows // ROWS_PER_TASK)), min(cores, 4 * rows // ROWS_PER_TASK))


def prepared(train: DataFrame, cols: list[str], med: dict, scale: dict | None = None):
    """(stages, vectors): the preprocessing, and the train rows put through it, kept for
    the fits' many passes in as many partitions as the rows call for.

    They are computed at once, while nothing else runs: every executor gets its share of
    the partitions.  A fit's tasks run where its vectors lie, so vectors that were
    computed beside other work, all on the one executor that was free, leave the rest of
    the cluster idle for the whole fit."""
    stages = [preprocess_stage(cols, med, scale), _assembler(cols)]
    vectors = PipelineModel(stages).transform(train).select(VEC, config.LABEL).coalesce(fit_tasks(train)).persist()
    vectors.count()
    return stages, vectors


def fit_prepared(estimator, train: DataFrame, cols: list[str], med: dict, scale: dict | None = None, ready=None) -> PipelineModel:
    """Fits on the assembled vectors, made once (``ready``: by the caller, who keeps
    them)."""
    stages, vectors = ready or prepared(train, cols, med, scale)
    try:
        return PipelineModel([*stages, estimator.fit(vectors)])
    finally:
        if not ready:
            vectors.unpersist()


def _scale(train: DataFrame, cols: list[str], med: dict) -> dict[str, tuple]:
    return {r["feature"]: (r["mean"], r["std"]) for r in standardization(train, cols, med).collect()}


def fit_logreg(train: DataFrame, cols: list[str], med: dict | None = None, ready=None) -> PipelineModel:
    """Median impute -> standardise -> L2 logistic regression (C = 1)."""
    med = med if med is not None else _medians_dict(train_medians(train, cols))
    n = train.count()
    lr = LogisticRegression(featuresCol=VEC, labelCol=config.LABEL, maxIter=1000,
                            regParam=1.0 / n, elasticNetParam=0.0, standardization=False)
    return fit_prepared(lr, train, cols, med, None if ready else _scale(train, cols, med), ready)


def fit_tree(train: DataFrame, cols: list[str], med: dict | None = None, ready=None) -> PipelineModel:
    """Median impute -> depth-5 tree, at least 20 rows per leaf."""
    med = med if med is not None else _medians_dict(train_medians(train, cols))
    dt = DecisionTreeClassifier(featuresCol=VEC, labelCol=config.LABEL, maxDepth=5,
                                minInstancesPerNode=20, impurity="gini", maxBins=256,
                                seed=config.RANDOM_STATE)
    return fit_prepared(dt, train, cols, med, ready=ready)


def gbt_estimator(params: dict) -> GBTClassifier:
    """Map the search parameters onto Spark's GBT (column sampling is per node, not
    per tree)."""
    frac = params.get("colsample_bytree", 1.0)
    return GBTClassifier(
        featuresCol=VEC, labelCol=config.LABEL, lossType="logistic",
        maxIter=int(params.get("n_estimators", 100)), maxDepth=int(params.get("max_depth", 3)),
        stepSize=float(params.get("learning_rate", 0.1)),
        subsamplingRate=float(params.get("subsample", 1.0)),
        featureSubsetStrategy="all" if frac >= 1.0 else str(frac),
        maxBins=256, seed=config.RANDOM_STATE)


def fit_gbt(train: DataFrame, cols: list[str], params: dict, med: dict | None = None, ready=None) -> PipelineModel:
    med = med if med is not None else _medians_dict(train_medians(train, cols))
    return fit_prepared(gbt_estimator(params), train, cols, med, ready=ready)


def time_series_folds(train: DataFrame, splits: int = config.CV_SPLITS) -> DataFrame:
    """Expanding-window folds over the train rows in (date, GAME_ID) order:
    fold size n // (splits + 1); fold k tests its block and trains on every
    earlier row.  Adds row_idx and test_fold (null = never a test row)."""
    idx = ordered.row_index_by_date(train, ["GAME_DATE_EST", "GAME_ID"], "row_idx")
    n = train.count()
    size = n // (splits + 1)
    start = n - splits * size
    fold = F.when(F.col("row_idx") >= start, F.floor((F.col("row_idx") - start) / size))
    return idx.withColumn("test_fold", fold.cast("int")).withColumn("_start", F.lit(start)) \
              .withColumn("_size", F.lit(size))


def fold_frames(folds: DataFrame, k: int):
    start, size = folds.select("_start", "_size").first()
    lo = start + k * size
    tr = folds.filter(F.col("row_idx") < lo)
    te = folds.filter((F.col("row_idx") >= lo) & (F.col("row_idx") < lo + size))
    return tr, te


def probability(scored: DataFrame) -> DataFrame:
    return scored.withColumn("prob", vector_to_array("probability")[1])


# the search parameters that Spark's trees have; there is no L2 on leaf weights, so
# ``reg_lambda`` is not drawn
DRAWN = ("n_estimators", "max_depth", "learning_rate", "subsample", "colsample_bytree")


def draw_params(draws: int = config.GBT_SEARCH_DRAWS, seed: int = config.RANDOM_STATE,
                space: dict | None = None) -> list[dict]:
    rng = random.Random(seed)
    space = space or {k: config.GBT_SEARCH_SPACE[k] for k in DRAWN}
    return [{k: rng.choice(v) for k, v in space.items()} for _ in range(draws)]


def tune_gbt(train: DataFrame, cols: list[str], draws: int = config.GBT_SEARCH_DRAWS,
             splits: int = config.CV_SPLITS, parallelism: int = 8, space: dict | None = None):
    """Random search scored by mean ROC-AUC over expanding time folds (never
    shuffled folds), then refit of the best draw on all train rows.

    Every fold is imputed with the medians of the rows before its test block (no
    fold sees a later game) and assembled into vectors once, which all draws share.
    The (draw, fold) fits run side by side from a thread pool, each in a scheduler
    pool of its own (fair sharing where ``spark.scheduler.mode`` is FAIR)."""
    folds = time_series_folds(train, splits).persist()
    cands = draw_params(draws, space=space)
    context = train.sparkSession.sparkContext
    frames = []
    for k in range(splits):
        tr, te = fold_frames(folds, k)
        stages = PipelineModel([preprocess_stage(cols, _medians_dict(train_medians(tr, cols)), None), _assembler(cols)])
        frames.append([stages.transform(x).select(VEC, config.LABEL).persist() for x in (tr, te)])
    by_rank = BinaryClassificationEvaluator(labelCol=config.LABEL, numBins=0)  # exact, ties count one half

    def score(job):
        p, k = job
        context.setLocalProperty("spark.scheduler.pool", f"search-{threading.get_ident()}")
        tr, te = frames[k]
        return by_rank.evaluate(gbt_estimator(cands[p]).fit(tr).transform(te))

    jobs = [(p, k) for p in range(len(cands)) for k in range(splits)]
    # the longest fits first
    order = sorted(jobs, key=lambda j: (-cands[j[0]].get("n_estimators", 0) * cands[j[0]].get("max_depth", 0), -j[1]))
    with ThreadPoolExecutor(max_workers=parallelism) as ex:
        auc = dict(zip(order, ex.map(score, order)))
    scores = [sum(auc[p, k] for k in range(splits)) / splits for p in range(len(cands))]
    best = max(range(len(cands)), key=lambda i: (scores[i], -i))
    for df in [folds, *(x for f in frames for x in f)]:
        df.unpersist()
    return fit_gbt(train, cols, cands[best]), cands[best], scores


# fixed configuration used when the random search is skipped
DEFAULT_GBT = {"n_estimators": 100, "max_depth": 3, "learning_rate": 0.1, "subsample": 1.0,
               "colsample_bytree": 1.0}


def train_all(train: DataFrame, test: DataFrame, cols: list[str], tune: bool = True,
              gbt_params: dict | None = None, stored: bool = False, **search) -> dict:
    """Fit the three model families and score each on the test split.  ``stored``:
    ``train`` is read from a written table, of which no second copy is held."""
    train = train if stored else train.persist()
    med = _medians_dict(train_medians(train, cols))  # one exact pass, shared by all models
    out = {}
    # one set of vectors for the regression, then one for the trees: a fit holds a form of
    # its own beside them, so the regression's are gone before the trees' are made
    scaled = prepared(train, cols, med, _scale(train, cols, med))
    out["logistic_regression"] = {"model": fit_logreg(train, cols, med, scaled)}
    scaled[1].unpersist()
    plain = prepared(train, cols, med)
    with ThreadPoolExecutor(max_workers=1) as ex:  # beside the ensemble's many short jobs
        first = ex.submit(lambda: fit_tree(train, cols, med, plain))
        if tune:
            m, p, _ = tune_gbt(train, cols, **search)
        else:
            p = gbt_params or DEFAULT_GBT
            m = fit_gbt(train, cols, p, med, plain)
        out["decision_tree"] = {"model": first.result()}
    plain[1].unpersist()
    out["gradient_boosted_trees"] = {"model": m, "params": p}
    for name, entry in out.items():
        s = probability(entry["model"].transform(test)).select(F.col(config.LABEL).alias("y"), "prob")
        entry["metrics"] = metrics.classification_metrics(s).first().asDict()
    if not stored:
        train.unpersist()
    return out


def comparison_table(spark, results: dict) -> DataFrame:
    """One row per model with its six metrics (small: one row per model)."""
    rows = [(name, *[float(e["metrics"][k]) for k in
                     ("accuracy", "precision", "recall", "f1", "roc_auc", "log_loss")])
            for name, e in results.items()]
    return spark.createDataFrame(rows, "model string, accuracy double, precision double, recall double, "
                                       "f1 double, roc_auc double, log_loss double")


def select_best(results: dict):
    """Highest test ROC-AUC; the first model wins ties."""
    names = list(results)
    best = max(range(len(names)), key=lambda i: (results[names[i]]["metrics"]["roc_auc"], -i))
    return names[best], results[names[best]]


def feature_importance(model: PipelineModel, cols: list[str], top: int = config.TOP_IMPORTANCES):
    """Tree importances, else |coefficients|; one value per feature; top k."""
    est = model.stages[-1]
    if hasattr(est, "featureImportances"):
        vals = est.featureImportances.toArray().tolist()
    elif hasattr(est, "coefficients"):
        vals = [abs(v) for v in est.coefficients.toArray().tolist()]
    else:
        raise ValueError(f"{type(est).__name__} has neither importances nor coefficients")
    if len(vals) != len(cols):
        raise ValueError(f"{len(vals)} importances for {len(cols)} features")
    spark = model.stages[0].sparkSession if hasattr(model.stages[0], "sparkSession") else None
    from pyspark.sql import SparkSession
    spark = spark or SparkSession.getActiveSession()
    df = spark.createDataFrame(list(zip(cols, [float(v) for v in vals])), "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature").limit(top)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Probability of a home win, its complement and the decision."""
    s = probability(model.transform(df))
    return s.withColumn("home_win_prob", F.col("prob")) \
            .withColumn("away_win_prob", F.lit(1.0) - F.col("prob")) \
            .withColumn("predicted_winner", C.winner_name("prob")) \
            .withColumn("threshold", F.lit(config.DECISION_THRESHOLD))


# ---- persistence -------------------------------------------------------------------

def save_artifacts(spark, model: PipelineModel, cols: list[str], path: str) -> None:
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(cols),)], "feature_columns string") \
        .coalesce(1).write.mode("overwrite").json(f"{path}/feature_columns")


def load_artifacts(spark, path: str):
    model = PipelineModel.load(f"{path}/model")
    cols = json.loads(spark.read.json(f"{path}/feature_columns").first()["feature_columns"])
    return model, cols


def load_or_train(spark, path: str, train: DataFrame, test: DataFrame, cols: list[str], **kw):
    """Load both artifacts if both exist, else train, select the best, save.
    Any other failure to read them is raised, never papered over by a refit."""
    from ..sources import sinks
    if sinks.exists(spark, f"{path}/model") and sinks.exists(spark, f"{path}/feature_columns"):
        return load_artifacts(spark, path)
    results = train_all(train, test, cols, **kw)
    _, best = select_best(results)
    save_artifacts(spark, best["model"], cols, path)
    return best["model"], cols
