"""Claim-delay classifiers and the delay-length regressor, on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.quantiles import quantiles
from ..operators.schema import feature_columns
from ..operators.sizes import literal_rows
from ..session import stage
from .boosting import BoostedTrees
from .boosting import fit as fit_boosted
from .claims import DAYS

TARGET = "is_delayed"
SEED = 42
TEST_SHARE = 0.2
MIN_DURATION_ROWS = 100
HASHED_FEATURES = 4096

# Columns that identify a claim or tell its outcome.
NOT_FEATURES = (
    "claim_id", "client_id", "contract_id", "vehicle_id",
    "date_sinistre_claim", "est_frauduleux_claim", "claim_severity_bucket",
)


@dataclass
class TrainingSize:
    """Ensemble sizes; the defaults are the production ones."""

    trees: int = 100
    tree_depth: int = 10
    rounds: int = 100
    boost_depth: int = 6
    rate: float = 0.1


@dataclass
class Trained:
    models: dict[str, PipelineModel]
    metrics: DataFrame
    best: str
    scored: dict[str, DataFrame] = field(default_factory=dict)


def labelled(df: DataFrame) -> DataFrame:
    return df.filter(F.col(TARGET).isNotNull()).withColumn(TARGET, F.col(TARGET).cast("int"))


def training_features(ml_claim: DataFrame) -> DataFrame:
    """Labelled rows without the columns that are no features."""
    return labelled(ml_claim).drop(*NOT_FEATURES)


def split_order(key: str = "claim_id", seed: int = SEED) -> Column:
    """A number below 2**52 that shuffles rows the same way in every run and engine."""
    digest = F.md5(F.concat(F.col(key), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")


def stratified_split(df: DataFrame, key: str = "claim_id", share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Adds ``split``: the ``share`` of each class that comes first in a seeded order is ``test``.

    The cut-off of each class is an exact order statistic of that number, so the shares are
    exact without ranking a whole class in one task.
    """
    marked = df.withColumn("__order", split_order(key, seed))
    per_class = {f"c{v}": (F.when(F.col(TARGET) == v, F.col("__order")), (share,)) for v in (0, 1)}
    cuts = quantiles(marked, per_class)
    test = F.lit(False)
    for v in (0, 1):
        if cuts[f"c{v}"][0] is not None:
            test = test | ((F.col(TARGET) == v) & (F.col("__order") <= cuts[f"c{v}"][0]))
    return marked.withColumn("split", F.when(test, "test").otherwise("train")).drop("__order")


def split_balance(parts: DataFrame) -> DataFrame:
    """Rows of each class in each split, and their share of the split."""
    counts = parts.groupBy("split", TARGET).agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy("split")))


def class_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(TARGET).agg(F.count(F.lit(1)).alias("rows"))


def class_weights(df: DataFrame) -> DataFrame:
    """Per class: rows, balanced weight n/(k*n_c), and negatives per positive for boosting."""
    counts = class_counts(df)
    total = counts.agg(
        F.sum("rows").alias("n"),
        F.count(F.lit(1)).alias("k"),
        F.sum(F.when(F.col(TARGET) == 0, F.col("rows"))).alias("neg"),
        F.sum(F.when(F.col(TARGET) == 1, F.col("rows"))).alias("pos"),
    ).select(F.struct("*").alias("t")).scalar()
    return counts.select(
        TARGET, "rows",
        (total["n"] / (total["k"] * F.col("rows"))).alias("balanced_weight"),
        F.when(F.col(TARGET) == 1, total["neg"] / total["pos"]).otherwise(1.0).alias("boost_weight"),
    )


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    return {c: v[0] for c, v in quantiles(df, {c: (F.col(c), (0.5,)) for c in columns}).items()}


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per text column, the smallest one on a tie, and its number of rows."""
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    counts = (
        df.select(F.inline(F.array(*pairs))).filter("value is not null")
        .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("rows"))
    )
    best = F.min(F.struct((-F.col("rows")).alias("minus"), "value")).alias("b")
    return counts.groupBy("column_name").agg(best).select(
        "column_name", F.col("b.value").alias("value"), (-F.col("b.minus")).alias("rows")
    )


def scaling(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation per column, one row each; a constant column gets 1."""
    one = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(c)["m"].alias("mean"),
                 F.when(F.col(c)["s"] == 0, 1.0).otherwise(F.col(c)["s"]).alias("deviation"))
        for c in columns
    ]
    return one.select(F.inline(F.array(*rows)))


def _quoted(value) -> str:
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return f"{value!r}D"


def preprocessing(train: DataFrame, hashed: Sequence[str] = ()) -> Pipeline:
    """Median/mode filling, scaling and one-hot coding, with statistics of ``train`` only.

    An index of a text column's values is held on the driver. For columns of free text, whose values grow with the
    rows, the caller names them in ``hashed``: they go to ``HASHED_FEATURES`` slots. Columns without any value are left out.
    """
    kinds = {c: k for c, k in feature_columns(train.drop(TARGET)).items() if k}
    fills: dict[str, object] = dict(medians(train, [c for c, k in kinds.items() if k == "numeric"]))
    texts = [c for c, k in kinds.items() if k == "text"]
    if texts:
        fills |= {r["column_name"]: r["value"] for r in modes(train, texts).collect()}
    numeric = [c for c, k in kinds.items() if k == "numeric" and fills.get(c) is not None]
    coded = [c for c in texts if c in fills and c not in hashed]
    hashed = [c for c in texts if c in fills and c in hashed]
    filled = [f"coalesce(cast(`{c}` as {'double' if c in numeric else 'string'}), {_quoted(fills[c])}) as `{c}__f`"
              for c in (*numeric, *coded, *hashed)]
    stages = [SQLTransformer(statement=f"select *, {', '.join(filled)} from __THIS__")]
    parts = []
    if numeric:
        stages += [
            VectorAssembler(inputCols=[f"{c}__f" for c in numeric], outputCol="__numbers"),
            StandardScaler(withMean=True, withStd=True, inputCol="__numbers", outputCol="__scaled"),
        ]
        parts.append("__scaled")
    if coded:
        indexed, hot = [f"{c}__i" for c in coded], [f"{c}__h" for c in coded]
        stages += [
            StringIndexer(inputCols=[f"{c}__f" for c in coded], outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True),
        ]
        parts += hot
    if hashed:
        stages.append(FeatureHasher(inputCols=[f"{c}__f" for c in hashed], outputCol="__hashed", numFeatures=HASHED_FEATURES))
        parts.append("__hashed")
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return Pipeline(stages=stages)


def delay_probability(c: str = "probability") -> Column:
    return vector_to_array(F.col(c))[1]


def train_delay_models(
    ml_claim: DataFrame, size: TrainingSize | None = None, share: float = TEST_SHARE, seed: int = SEED, hashed: Sequence[str] = ()
) -> Trained:
    """Random forest and boosted trees on the train split, measured on the test split. The boosted trees bin the columns themselves, missing ones apart.

    The split, the prepared rows and each scored test set are written once and read from there.
    """
    size = size or TrainingSize()
    parts = stratified_split(labelled(ml_claim), share=share, seed=seed)
    ids = [c for c in NOT_FEATURES if c != "claim_id"]
    parts = stage(parts.drop(*ids), "split")
    train, test = (parts.filter(F.col("split") == s).drop("split") for s in ("train", "test"))
    weights = {r[TARGET]: r for r in class_weights(train).collect()}
    if set(weights) != {0, 1}:
        raise ValueError(f"both classes are needed for training, found {sorted(weights)}")
    prepared = preprocessing(train.drop("claim_id"), hashed).fit(train)

    def weight(name: str) -> Column:
        return F.when(F.col(TARGET) == 1, weights[1][name]).otherwise(weights[0][name])

    ready = stage(prepared.transform(train).select(
        TARGET, "features", weight("balanced_weight").alias("__balanced")
    ), "prepared")
    forest = RandomForestClassifier(
        labelCol=TARGET, weightCol="__balanced", numTrees=size.trees, maxDepth=size.tree_depth, seed=seed, cacheNodeIds=True
    )
    kinds = feature_columns(train.drop(TARGET, "claim_id"))
    numbers, texts = ([c for c, k in kinds.items() if k == kind] for kind in ("numeric", "text"))

    def boosted() -> PipelineModel:
        return PipelineModel([BoostedTrees(fit_boosted(train, TARGET, numbers, texts, size.rounds, size.boost_depth, size.rate))])

    models, scored, results = {}, {}, []
    for name, fitted in (("random_forest", lambda: PipelineModel([*prepared.stages, forest.fit(ready)])), ("boosted_trees", boosted)):
        model = fitted()
        result = stage(model.transform(test).select("claim_id", TARGET, delay_probability().alias("delay_probability"), "prediction"), "scored")
        models[name], scored[name] = model, result
        results.append(model_metrics(result, name))
    metrics = results[0].unionByName(results[1])
    rows = metrics.select("model", "auc").collect()
    return Trained(models, metrics, best_by_auc({r["model"]: r["auc"] for r in rows}), scored)


def best_by_auc(auc: dict[str, float]) -> str:
    """The higher AUC wins, the random forest on a tie."""
    return max(auc, key=lambda name: (auc[name], name == "random_forest"))


def best_model(metrics: DataFrame) -> DataFrame:
    order = F.struct(F.col("auc"), F.col("model") == "random_forest")
    return metrics.agg(F.max_by("model", order).alias("model"), F.max("auc").alias("auc"))


def confusion_matrix(scored: DataFrame, label: str = TARGET, prediction: str = "prediction") -> DataFrame:
    return scored.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("predicted")
    ).agg(F.count(F.lit(1)).alias("rows"))


def classification_report(scored: DataFrame, label: str = TARGET, prediction: str = "prediction") -> DataFrame:
    """Per class: precision, recall, F1 and support; zero where a quotient is undefined."""
    cells = confusion_matrix(scored, label, prediction)
    sides = cells.select(
        F.inline(F.array(
            F.struct(F.col("label").alias("class"), F.lit(0).alias("as_predicted"), F.lit(1).alias("as_label"), "rows", "label", "predicted"),
            F.struct(F.col("predicted").alias("class"), F.lit(1).alias("as_predicted"), F.lit(0).alias("as_label"), "rows", "label", "predicted"),
        ))
    )
    hit = (F.col("label") == F.col("predicted")) & (F.col("as_label") == 1)
    per = sides.groupBy("class").agg(
        F.sum(F.when(hit, F.col("rows")).otherwise(0)).alias("tp"),
        F.sum(F.col("rows") * F.col("as_predicted")).alias("predicted"),
        F.sum(F.col("rows") * F.col("as_label")).alias("support"),
    )

    def quotient(a: Column, b: Column) -> Column:
        return F.when(b == 0, 0.0).otherwise(a / b)

    precision, recall = quotient(F.col("tp"), F.col("predicted")), quotient(F.col("tp"), F.col("support"))
    return per.select(
        "class", precision.alias("precision"), recall.alias("recall"),
        quotient(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"), "support",
    )


def roc_auc(scored: DataFrame, label: str = TARGET, score: str = "delay_probability") -> float:
    """Exact area under the ROC curve, ties counted half, by a distributed sort."""
    ready = scored.select(F.col(label).cast("double").alias("label"), F.col(score).cast("double").alias("score"))
    return BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0).evaluate(ready)


def model_metrics(scored: DataFrame, name: str) -> DataFrame:
    """One row: model, accuracy, AUC, precision and recall of the delayed class, test rows."""
    late, called = F.col(TARGET) == 1, F.col("prediction") == 1
    row = scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(TARGET) == F.col("prediction")).alias("right"),
        F.count_if(late & called).alias("tp"), F.count_if(called).alias("called"), F.count_if(late).alias("late"),
    ).first()
    values = (
        name, row["right"] / row["rows"], roc_auc(scored),
        row["tp"] / row["called"] if row["called"] else 0.0, row["tp"] / row["late"] if row["late"] else 0.0, row["rows"],
    )
    return literal_rows(scored.sparkSession, [values], ("model", "accuracy", "auc", "precision_delayed", "recall_delayed", "test_rows"))


def duration_rows(ml_claim: DataFrame, clean_claims: DataFrame) -> DataFrame:
    """Feature rows of delayed claims whose handling time is known, with that time."""
    known = clean_claims.filter((F.col(TARGET) == 1) & F.col(DAYS).isNotNull()).select("claim_id", DAYS)
    return ml_claim.drop(DAYS).join(known, "claim_id")


def train_duration_model(
    ml_claim: DataFrame, clean_claims: DataFrame, size: TrainingSize | None = None, seed: int = SEED, hashed: Sequence[str] = ()
) -> tuple[PipelineModel, DataFrame] | None:
    """Forest regressor of the handling days of delayed claims; None below 100 rows.

    The metrics hold one row for the rows trained on and one for held-out rows.
    """
    size = size or TrainingSize()
    rows = duration_rows(ml_claim, clean_claims)
    if rows.limit(MIN_DURATION_ROWS).count() < MIN_DURATION_ROWS:
        return None
    held = split_order(seed=seed) < TEST_SHARE * 2.0**52
    rows = stage(rows.withColumn("__held", held).drop(*[c for c in NOT_FEATURES if c != "claim_id"]), "split")
    train, test = rows.filter(~F.col("__held")).drop("__held"), rows.filter("__held").drop("__held")
    prepared = preprocessing(train.drop("claim_id", DAYS), hashed).fit(train)
    forest = RandomForestRegressor(labelCol=DAYS, numTrees=size.trees, maxDepth=size.tree_depth, seed=seed, cacheNodeIds=True)
    ready = stage(prepared.transform(train).select(DAYS, "features"), "prepared")
    model = PipelineModel([*prepared.stages, forest.fit(ready)])
    parts = [regression_metrics(model.transform(d), DAYS, "prediction").withColumn("split", F.lit(s))
             for s, d in (("train", train), ("test", test))]
    return model, parts[0].unionByName(parts[1])


def regression_metrics(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: mean absolute error, R2 and the number of rows."""
    error = F.col(label) - F.col(prediction)
    return scored.agg(
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.sum(error * error) / (F.var_pop(label) * F.count(label))).alias("r2"),
        F.count(label).alias("rows"),
    )


def save_models(trained: Trained, folder: str, duration: PipelineModel | None = None) -> None:
    """Every model, the best one under its own name, metrics, class reports and confusion matrices of all, and the duration model if any."""
    for name, model in trained.models.items():
        model.write().overwrite().save(f"{folder}/{name}")
    trained.models[trained.best].write().overwrite().save(f"{folder}/delay")
    trained.metrics.write.mode("overwrite").parquet(f"{folder}/metrics")
    for name, scored in trained.scored.items():
        classification_report(scored).write.mode("overwrite").parquet(f"{folder}/reports/model={name}")
        confusion_matrix(scored).write.mode("overwrite").parquet(f"{folder}/matrices/model={name}")
    if duration is not None:
        duration.write().overwrite().save(f"{folder}/duration")


def load_delay_model(spark: SparkSession, folder: str) -> PipelineModel:
    try:
        spark.read.text(f"{folder}/delay/metadata")
    except AnalysisException as e:
        raise FileNotFoundError(f"no delay model in {folder}; train one first") from e
    return PipelineModel.load(f"{folder}/delay")


def load_duration_model(spark: SparkSession, folder: str) -> PipelineModel | None:
    try:
        spark.read.text(f"{folder}/duration/metadata")
    except AnalysisException:
        return None
    return PipelineModel.load(f"{folder}/duration")
