"""Features, encoders, models, metrics and scoring, as ``pyspark.ml`` parts and plain aggregates."""

from __future__ import annotations

import itertools
import random
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelog.operators.ranks import ranked, running_sums
from parcelog.operators.summaries import newest_share
from parcelog.storage import materialize


def columns_by_type(df: DataFrame, but: tuple[str, ...] = ()) -> tuple[list[str], list[str]]:
    """(numeric, other) columns."""
    numeric = [
        f.name for f in df.schema.fields if f.dataType.simpleString().split("(")[0] in ("int", "bigint", "double", "float", "smallint", "decimal") and f.name not in but
    ]
    return numeric, [k for k in df.columns if k not in numeric and k not in but]


def hash_share(*columns: str) -> Column:
    """A repeatable number from 0 to 1 of a row's key."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in columns])), 1, 8), 16, 10).cast("double") / 2**32


def stratified_split(df: DataFrame, key: str, label: str, share: float, seed: int = 0) -> DataFrame:
    """``is_test`` for exactly a share of the rows of each label (to the nearest row, halves up), drawn by hash of the key.

    Of each label the last draw that belongs to the test is found by numbering (label, draw, key) alone over ranges, so a label of
    any size is drawn from by many tasks and the rows stay where they are. Null labels are one; keys should tell rows apart.
    """
    drawn = F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string")))
    slim = df.select(F.col(label).alias("label_"), drawn.alias("draw_"), F.col(key).alias("key_"))
    placed = running_sums(slim, ["label_"], ["draw_", "key_"], {"place_": F.lit(1)})
    sizes = slim.groupBy("label_").agg(F.count("*").alias("n_")).withColumnRenamed("label_", "of_")
    wanted = F.floor(F.col("n_") * share + 0.5)
    cuts = placed.join(sizes, F.col("label_").eqNullSafe(F.col("of_"))).filter(F.col("place_") == wanted)  # a row for each label
    cuts = cuts.select("of_", F.struct("draw_", "key_").alias("last_"))
    joined = df.withColumn("own_", F.struct(drawn.alias("draw_"), F.col(key).alias("key_"))).join(cuts, F.col(label).eqNullSafe(F.col("of_")), "left")
    return joined.withColumn("is_test", F.coalesce(F.col("own_") <= F.col("last_"), F.lit(False))).select(*df.columns, "is_test")


def label_index(df: DataFrame, column: str) -> DataFrame:
    """``index`` from 0 in the order of the labels, of which there may be many; rows without label go."""
    labels = ranked(df.select(column).filter(F.col(column).isNotNull()).distinct(), column, name="place_")
    return df.join(labels.select(column, (F.col("place_") - 1).cast("int").alias("index")), column)


def target_encode(df: DataFrame, column: str, target: str, key: str, folds: int = 5, smooth: float = 10.0) -> DataFrame:
    """``encoded``: the category's mean target over the other folds, drawn to the overall mean; folds by hash of the key.

    Sums are taken by category and fold, so a fold's own part is subtracted without another pass.
    """
    own = df.withColumn("fold_", F.floor(hash_share(key) * folds).cast("int"))
    cells = own.groupBy(column, "fold_").agg(F.sum(target).cast("double").alias("s"), F.count(target).alias("m"))
    every = Window.partitionBy(column)  # a row for each fold
    by_fold = cells.groupBy("fold_").agg(F.sum("s").alias("fs_"), F.sum("m").alias("fm_"))
    whole = Window.partitionBy(F.lit(1))  # over the folds
    rest = by_fold.select("fold_", ((F.sum("fs_").over(whole) - F.col("fs_")) / (F.sum("fm_").over(whole) - F.col("fm_"))).alias("p_"))
    cells = cells.withColumns({"s_": F.sum("s").over(every) - F.col("s"), "m_": F.sum("m").over(every) - F.col("m")}).join(F.broadcast(rest), "fold_")
    encoded = cells.select(column, "fold_", ((F.col("s_") + smooth * F.col("p_")) / (F.col("m_") + smooth)).alias("encoded"))
    return own.join(encoded, [column, "fold_"]).drop("fold_")


def preprocessor(numeric: list[str], categories: list[str]) -> list:
    """Stages: medians for missing numbers, categories indexed and one-hot with room for new ones, numbers scaled."""
    filled = [f"{k}_filled" for k in numeric]
    return [
        Imputer(inputCols=numeric, outputCols=filled, strategy="median"), StringIndexer(inputCols=categories, outputCols=[f"{k}_index" for k in categories], handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=[f"{k}_index" for k in categories], outputCols=[f"{k}_hot" for k in categories], dropLast=True), VectorAssembler(inputCols=filled, outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=False), VectorAssembler(inputCols=["scaled", *[f"{k}_hot" for k in categories]], outputCol="features"),
    ]


MODELS = {
    "clf_boosted": lambda y: GBTClassifier(labelCol=y, maxIter=10, maxDepth=4, seed=1),
    "logistic": lambda y: LogisticRegression(labelCol=y, maxIter=20),
    "tree": lambda y: DecisionTreeClassifier(labelCol=y, maxDepth=4, seed=1),
    "reg_boosted": lambda y: GBTRegressor(labelCol=y, maxIter=10, maxDepth=4, seed=1),
    "linear": lambda y: LinearRegression(labelCol=y, maxIter=20),
    "reg_tree": lambda y: DecisionTreeRegressor(labelCol=y, maxDepth=4, seed=1),
}


def fit(df: DataFrame, kind: str, label: str, numeric: list[str], categories: list[str]) -> PipelineModel:
    return Pipeline(stages=[*preprocessor(numeric, categories), MODELS[kind](label)]).fit(df)


def score(model: PipelineModel, df: DataFrame, *keep: str) -> DataFrame:
    """``score`` (probability of label 1, or the predicted number) beside the kept columns."""
    out = model.transform(df)
    value = vector_to_array("probability")[1] if "probability" in out.columns else F.col("prediction")
    return out.select(*keep, value.alias("score"))


def stratified_folds(df: DataFrame, key: str, label: str, folds: int, seed: int = 0) -> DataFrame:
    """``fold`` from 0, dealt in turn among the rows of each label in an order drawn by hash of the key."""
    own = df.withColumn("draw_", F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string"))))
    own = ranked(own, F.asc_nulls_first(label), F.asc("draw_"), F.asc(key), name="place_")
    return own.withColumn("fold", (F.col("place_") % folds).cast("int")).drop("draw_", "place_")


def drawn_parameters(spaces: list[dict[str, list]], n: int, seed: int = 0) -> list[dict]:
    """n different settings drawn at random from all combinations of the spaces (all of them, if they are fewer)."""
    settings = [dict(zip(space, values, strict=True)) for space in spaces for values in itertools.product(*space.values())]
    return random.Random(seed).sample(settings, min(n, len(settings)))


#: Settings of a fold that are fitted at a time; each keeps its rows in memory, what does not fit on disk.
SIDE_BY_SIDE = 2


def random_search(df: DataFrame, key: str, label: str, numeric: list[str], categories: list[str], spaces: list[dict[str, list]], n: int = 8, folds: int = 3, seed: int = 0) -> list[tuple[float, dict]]:
    """(mean ROC area over stratified folds, setting) of settings drawn at random, the best first.

    A setting names a model of ``MODELS`` under ``model`` and parameters of it. Folds are dealt among the columns that count only.
    Data are prepared once a fold and kept for its settings, of which some are fitted side by side, so that the last tasks of one
    leave no core idle. Areas are of probabilities, as a tree's raw predictions are counts of rows, which tell leaves' sizes.
    """
    dealt = materialize(stratified_folds(df.select(*dict.fromkeys([key, label, *numeric, *categories])), key, label, folds, seed), "folds")
    settings = drawn_parameters(spaces, n, seed)
    areas: list[list[float]] = [[] for _ in settings]
    for fold in range(folds):
        known = dealt.filter(F.col("fold") != fold)
        prepared = Pipeline(stages=preprocessor(numeric, categories)).fit(known)
        train, test = (prepared.transform(x).select(label, "features").persist(StorageLevel.MEMORY_AND_DISK) for x in (known, dealt.filter(F.col("fold") == fold)))

        @inheritable_thread_target(df.sparkSession)
        def area(setting: dict, train: DataFrame = train, test: DataFrame = test) -> float:
            model = MODELS[setting["model"]](label)
            model.setParams(**{k: v for k, v in setting.items() if k != "model"})
            return classifier_metrics(score(model.fit(train), test, label), label).first()["roc_auc"]

        with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
            for own, found in zip(areas, pool.map(area, settings), strict=True):
                own.append(found)
        train.unpersist()
        test.unpersist()
    found = [(sum(a) / folds, setting) for a, setting in zip(areas, settings, strict=True)]
    return sorted(found, key=lambda x: -x[0])


def train_with_holdout(df: DataFrame, kind: str, label: str, key: str, time: str, numeric: list[str], categories: list[str], share: float = 0.2) -> tuple[PipelineModel, DataFrame]:
    """A model of all rows, and the metrics (one row) of one that was fitted without the newest share and scored on it."""
    parted = materialize(newest_share(df, time, key, share), "holdout")
    newest = parted.filter("is_test")
    metrics = classifier_metrics(score(fit(parted.filter(~F.col("is_test")), kind, label, numeric, categories), newest, label), label)
    totals = parted.agg(F.count("*").alias("n_train"), F.round(F.avg(label), 6).alias("positive_rate"), F.max(time).alias("newest"))
    return fit(df, kind, label, numeric, categories), metrics.crossJoin(F.broadcast(totals))  # one row each


def importances(model: PipelineModel, df: DataFrame, n: int = 20) -> DataFrame:
    """The n most important features by name."""
    meta = model.transform(df.limit(1)).schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in meta.values() for a in group}
    weights = model.stages[-1].featureImportances.toArray()
    rows = sorted(((names.get(i, str(i)), float(w)) for i, w in enumerate(weights)), key=lambda x: (-x[1], x[0]))[:n]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def classifier_metrics(scored: DataFrame, label: str, value: str = "score", places: int = 6) -> DataFrame:
    """ROC area, average precision, accuracy at one half; scores that round alike are one threshold, so at most 10^places
    thresholds are sorted."""
    bins = scored.groupBy(F.round(value, places).alias("t")).agg(
        F.sum(F.col(label).cast("long")).alias("p"),
        F.count("*").alias("n"),
        F.sum((F.col(label) == (F.col(value) >= 0.5).cast("int")).cast("long")).alias("right"),
    )
    above = Window.orderBy(F.desc("t"))
    bins = bins.withColumns({"tp": F.sum("p").over(above), "all": F.sum("n").over(above)})
    q = F.col("n") - F.col("p")
    sums = bins.agg(
        F.sum("p").alias("pos_"),
        F.sum(q).alias("neg_"),
        F.sum(q * (F.col("tp") - F.col("p") / 2)).alias("area"),
        F.sum(F.col("p") * F.col("tp") / F.col("all")).alias("ap"),
        F.sum("right").alias("right"),
        F.sum("n").alias("n"),
    )
    return sums.select(
        F.round(F.col("area") / (F.col("pos_") * F.col("neg_")), places).alias("roc_auc"),
        F.round(F.col("ap") / F.col("pos_"), places).alias("average_precision"),
        F.round(F.col("right") / F.col("n"), places).alias("accuracy"),
        "n",
    )


def regression_metrics(df: DataFrame, label: str, value: str, places: int = 4) -> DataFrame:
    """MAE, RMSE and R² in one pass."""
    e = F.col(label) - F.col(value)
    return df.agg(
        F.round(F.avg(F.abs(e)), places).alias("mae"),
        F.round(F.sqrt(F.avg(e * e)), places).alias("rmse"),
        F.round(1 - F.sum(e * e) / F.nullif(F.var_pop(label) * F.count(label), F.lit(0.0)), places).alias("r2"),
    )


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    return df.groupBy(label, predicted).agg(F.count("*").alias("n"))
