"""Price regressors on Spark ML: preprocessing, models, evaluation, comparison."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayglass.operators.columns import quoted
from stayglass.operators.profile import metric_columns, regression_metrics
from stayglass.operators.rows import union_by_name
from stayglass.operators.sums import summed
from stayglass.plans.boosting import Boosting, BoostSettings, best_round  # noqa: F401
from stayglass.plans.forest import Forest, ForestSettings

SEED = 42


def feature_groups(df: DataFrame, features: Sequence[str], bool_as: str = "category") -> tuple[list[str], list[str]]:
    """(numeric, categorical) by column type; booleans go where ``bool_as`` says."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    numeric = [
        c for c in features
        if isinstance(kinds[c], T.NumericType)
        or (isinstance(kinds[c], T.BooleanType) and bool_as == "number")
    ]
    return numeric, [c for c in features if c not in numeric]


def _statement(columns: dict[str, str]) -> SQLTransformer:
    added = ", ".join(f"{expr} AS `{name}`" for name, expr in columns.items())
    return SQLTransformer(statement=f"SELECT *, {added} FROM __THIS__")


@dataclass
class Preprocessing:
    stages: list[Transformer]
    names: list[str]


def preprocess(train: DataFrame, features: Sequence[str], encode: str = "onehot") -> Preprocessing:
    """Stages fitted on the training rows that end in a ``features`` vector.

    ``onehot``: numbers standardised with the population deviation; categories one-hot without
    their first level, unseen ones all zeros. ``label``: numbers as they are, categories as sorted
    codes, unseen ones 0.
    """
    return preprocess_parts(train, [F.lit(True)], features, encode)[0]


def preprocess_parts(df: DataFrame, parts: Sequence[Column], features: Sequence[str], encode: str = "onehot") -> list[Preprocessing]:
    """``preprocess`` of the rows that each condition keeps; one scan for all."""
    numeric, categorical = feature_groups(df, features, "category" if encode == "onehot" else "number")
    facts = df.agg(*[
        F.struct(
            F.count_if(part).alias("n"),
            *[F.avg(F.when(part, quoted_column(c))).alias(f"m{i}") for i, c in enumerate(numeric) if encode == "onehot"],
            *[F.stddev_pop(F.when(part, quoted_column(c))).alias(f"s{i}") for i, c in enumerate(numeric) if encode == "onehot"],
            *[F.collect_set(F.when(part, quoted_column(c).cast("string"))).alias(f"k{i}") for i, c in enumerate(categorical)],
        ).alias(f"part{p}")
        for p, part in enumerate(parts)
    ]).first()
    return [_stages(df, numeric, categorical, row, encode) for row in facts]


def quoted_column(name: str) -> Column:
    return F.col(quoted(name))


def _stages(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], facts, encode: str) -> Preprocessing:
    empty = [c for i, c in enumerate(numeric) if encode == "onehot" and facts[f"m{i}"] is None]
    if empty:
        raise ValueError(f"no value in the training rows: {', '.join(empty)}")

    prepared = {}
    for i, c in enumerate(numeric):
        if encode == "onehot":
            scale = facts[f"s{i}"] or 1.0
            prepared[f"_num{i}"] = f"(CAST(`{c}` AS DOUBLE) - {facts[f'm{i}']!r}D) / {scale!r}D"
        else:
            prepared[f"_num{i}"] = f"CAST(`{c}` AS DOUBLE)"
    for i, c in enumerate(categorical):
        prepared[f"_text{i}"] = f"CAST(`{c}` AS STRING)"
    stages: list[Transformer] = [_statement(prepared)] if prepared else []
    inputs = [f"_num{i}" for i in range(len(numeric))]
    names = list(numeric)
    if categorical:
        # reversed order puts the first level last, where the encoder drops it; letters in the order of Java's strings
        levels = [sorted(facts[f"k{i}"], key=lambda x: x.encode("utf-16-be", "surrogatepass"), reverse=encode == "onehot") for i in range(len(categorical))]
        stages += [StringIndexerModel.from_labels(labels, inputCol=f"_text{i}", outputCol=f"_index{i}", handleInvalid="keep") for i, labels in enumerate(levels)]
        codes = {}
        for i, labels in enumerate(levels):
            unseen, code = len(labels), f"`_index{i}`"
            codes[f"_code{i}"] = (
                f"least({code}, {unseen - 1}D)" if encode == "onehot"
                else f"CASE WHEN {code} >= {unseen} THEN 0D ELSE {code} END"
            )
        stages.append(_statement(codes))
        if encode == "onehot":
            encoder = OneHotEncoder(
                inputCols=list(codes), outputCols=[f"_hot{i}" for i in range(len(codes))],
                dropLast=True, handleInvalid="error",
            )
            # the encoder takes the number of levels from the largest code
            most = [tuple(max(len(labels) - 1.0, 0.0) for labels in levels)]
            stages.append(encoder.fit(df.sparkSession.createDataFrame(most, ", ".join(f"{c} double" for c in codes))))
            inputs += [f"_hot{i}" for i in range(len(codes))]
            for c, labels in zip(categorical, levels):
                names += [f"{c}_{label}" for label in labels[:-1]]
        else:
            inputs += list(codes)
            names += categorical
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    return Preprocessing(stages, names)


def ols(df: DataFrame, label: str) -> LinearRegression:
    return LinearRegression(labelCol=label, standardization=False, regParam=0.0)


@dataclass
class Condensed:
    """A few weighted rows (features, label, weight) with the count, means and products of many."""

    rows: DataFrame
    n: int
    deviation: float

    @classmethod
    def of(cls, df: DataFrame, label: str) -> Condensed:
        """Of the ``features`` vectors and labels of ``df``, in one scan. Linear models depend on nothing else."""
        known = df.select(vector_to_array("features").alias("x"), F.col(quoted(label)).cast("double").alias("y"))
        first = known.where("y IS NOT NULL").first()
        if first is None:
            raise ValueError("no rows to learn from")
        m, shift = len(first.x) + 1, first.y

        def add(batches, total):
            for batch in batches:
                if not batch.num_rows:
                    continue
                y = batch.column("y")
                if y.null_count or np.isnan(y.to_numpy()).any():
                    raise ValueError("labels must not be null or NaN")
                z = np.empty((batch.num_rows, m))
                z[:, :-1] = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, m - 1)
                z[:, -1] = y.to_numpy() - shift
                total[0] += len(z)
                total[1 : m + 1] += z.sum(axis=0)
                total[m + 1 :] += (z.T @ z).reshape(-1)

        total = summed(known, 1 + m + m * m, add, df.rdd.getNumPartitions())
        n = int(total[0])
        mean, squares = total[1 : m + 1] / n, total[m + 1 :].reshape(m, m) / n
        spread = squares - np.outer(mean, mean)
        still = spread.diagonal() <= 1e-14 * squares.diagonal()  # columns of one value
        spread[still], spread[:, still] = 0.0, 0.0
        values, axes = np.linalg.eigh(spread)
        steps = (axes * np.sqrt(np.maximum(values, 0.0) * m)).T
        steps[:, still] = 0.0
        mean[-1] += shift
        rows = [(Vectors.dense(r[:-1]), float(r[-1]), n / (2 * m)) for step in steps for r in (mean + step, mean - step)]
        rows = df.sparkSession.createDataFrame(rows, ["features", label, CONDENSED_WEIGHT]).coalesce(1)
        return cls(rows, n, float(np.sqrt(spread[-1, -1])))


CONDENSED_WEIGHT = "_rows"


def _label_facts(df: DataFrame | Condensed, label: str) -> tuple[int, float]:
    if isinstance(df, Condensed):
        return df.n, df.deviation or 1.0
    row = df.agg(F.count(label), F.stddev_pop(label)).first()
    return row[0], row[1] or 1.0


def ridge(df: DataFrame, label: str, alpha: float = 1.0) -> LinearRegression:
    """Penalty ``alpha * |w|^2`` on the summed squared error; Spark divides by label deviation and rows."""
    n, sigma = _label_facts(df, label)
    return LinearRegression(labelCol=label, standardization=False, regParam=alpha * sigma / n, elasticNetParam=0.0)


def lasso(df: DataFrame, label: str, alpha: float = 0.1) -> LinearRegression:
    return LinearRegression(labelCol=label, standardization=False, regParam=alpha, elasticNetParam=1.0,
                            maxIter=2000)


def elastic_net(df: DataFrame, label: str, alpha: float = 0.1, l1_ratio: float = 0.5) -> LinearRegression:
    _, sigma = _label_facts(df, label)
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio) * sigma
    return LinearRegression(labelCol=label, standardization=False, regParam=l1 + l2,
                            elasticNetParam=l1 / (l1 + l2), maxIter=2000)


def forest(df: DataFrame, label: str) -> Forest:
    return Forest(label, ForestSettings(trees=50, depth=10, least=5, share="all", seed=SEED))


def enhanced_forest(df: DataFrame, label: str) -> Forest:
    return Forest(label, ForestSettings(trees=200, depth=15, least=2, share="sqrt", seed=SEED))


def boosted_trees(df: DataFrame, label: str, rounds: int = 100, held: str | None = None) -> Boosting:
    """Depth 6, rate 0.1, 80 % subsamples."""
    return Boosting(label, BoostSettings(rounds=rounds, depth=6, rate=0.1, subsample=0.8, seed=SEED), held)


HELD = "_held"


@dataclass(frozen=True)
class ModelSpec:
    name: str
    build: Callable[..., object]
    encode: str = "onehot"
    kind: str = "Baseline"
    patience: int | None = None  # rounds without gain on the validation rows after which boosting stops
    linear: bool = False  # depends on the rows by their count, means and products alone


BASELINES = [
    ModelSpec("Linear Regression", ols, linear=True),
    ModelSpec("Ridge Regression", ridge, linear=True),
    ModelSpec("Lasso Regression", lasso, linear=True),
    ModelSpec("ElasticNet Regression", elastic_net, linear=True),
    ModelSpec("Random Forest", forest),
]
ADVANCED = [
    ModelSpec("Enhanced Random Forest", enhanced_forest, "label", "Advanced"),
    ModelSpec("Gradient Boosting", boosted_trees, "label", "Advanced", patience=10),
]


def fit(spec: ModelSpec, train: DataFrame, features: Sequence[str], label: str,
        validation: DataFrame | None = None) -> tuple[PipelineModel, list[str]]:
    """Fitted pipeline and the names of its vector entries.

    A spec with ``patience`` stops early on ``validation``.
    """
    prep = preprocess(train, features, spec.encode)
    if spec.linear:
        return fit_linear([spec], prep, train, label)[0], prep.names
    if spec.patience is not None and validation is not None:
        columns = [*map(quoted, dict.fromkeys([*features, label]))]
        both = union_by_name(*[df.select(*columns).withColumn(HELD, F.lit(held)) for df, held in ((train, False), (validation, True))])
        return Pipeline(stages=[*prep.stages, spec.build(train, label).stopping(HELD, spec.patience)]).fit(both), prep.names
    return Pipeline(stages=[*prep.stages, spec.build(train, label)]).fit(train), prep.names


def fit_linear(specs: Sequence[ModelSpec], prep: Preprocessing, train: DataFrame, label: str) -> list[PipelineModel]:
    """Fitted pipelines of linear models; one scan of the training rows for all."""
    if not specs:
        return []
    data = Condensed.of(PipelineModel(prep.stages).transform(train), label)
    fitted = [spec.build(data, label).setWeightCol(CONDENSED_WEIGHT).fit(data.rows) for spec in specs]
    for model in fitted:
        model.clear(model.weightCol)
    return [PipelineModel([*prep.stages, model]) for model in fitted]


def predictions(models: Sequence[PipelineModel], df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` with a prediction column for each of several models behind the same preprocessing."""
    out = PipelineModel(models[0].stages[:-1]).transform(df)
    for model, name in zip(models, names):
        last = model.stages[-1]
        out = last.copy({last.predictionCol: name}).transform(out)
    return out


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Input columns plus ``prediction`` (log scale) and ``prediction_price``."""
    return model.transform(df).select(
        *[quoted(c) for c in df.columns], "prediction", F.expm1("prediction").alias("prediction_price")
    )


def metrics(model: PipelineModel, df: DataFrame, label: str, price: str) -> DataFrame:
    return regression_metrics(score(model, df), label, "prediction", price, "prediction_price")


def model_report(spec: ModelSpec, model: PipelineModel, train: DataFrame, val: DataFrame, label: str, price: str) -> DataFrame:
    """One row per part: model, kind, part and the metrics."""
    return union_by_name(*[
        metrics(model, df, label, price).select(
            F.lit(spec.name).alias("model"), F.lit(spec.kind).alias("kind"), F.lit(part).alias("part"), "*"
        )
        for part, df in (("train", train), ("val", val))
    ])


def leaderboard(report: DataFrame) -> DataFrame:
    """Train against validation per model, best validation R2 first, with the overfit gap."""
    def of(part: str, column: str):
        return F.max(F.when(F.col("part") == part, F.col(column)))

    return report.groupBy("model", "kind").agg(
        of("train", "rmse_orig").alias("train_rmse"),
        of("val", "rmse_orig").alias("val_rmse"),
        of("train", "mape").alias("train_mape"),
        of("val", "mape").alias("val_mape"),
        of("train", "r2_orig").alias("train_r2"),
        of("val", "r2_orig").alias("val_r2"),
        (of("train", "r2_orig") - of("val", "r2_orig")).alias("overfit"),
    ).orderBy(F.desc("val_r2"), "model")


def cross_validate(spec: ModelSpec, df: DataFrame, features: Sequence[str], label: str, fold: str,
                   folds: int = 3) -> DataFrame:
    """R2 on the log scale per fold; preprocessing is refitted for each."""
    if spec.linear:
        return cross_validate_linear([spec], df, features, label, fold, folds)
    parts = []
    for i in range(folds):
        model, _ = fit(spec, df.where(F.col(fold) != i), features, label)
        held = model.transform(df.where(F.col(fold) == i))
        parts.append(held.agg(*_fold_score(spec, i, label, "prediction")))
    return union_by_name(*parts)


def _fold_score(spec: ModelSpec, i: int, label: str, prediction: str) -> list[Column]:
    e = F.col(label) - F.col(prediction)
    return [
        F.lit(spec.name).alias("model"), F.lit(i).cast("bigint").alias("fold"),
        (1 - F.try_divide(F.sum(e * e), F.var_pop(label) * F.count(label))).alias("r2_log"),
    ]


def cross_validate_linear(specs: Sequence[ModelSpec], df: DataFrame, features: Sequence[str], label: str, fold: str,
                          folds: int = 3) -> DataFrame:
    """``cross_validate`` of linear models with one encoding: the folds share one scan for the preprocessing, the models
    of a fold one for the fits and one for the scores."""
    preps = preprocess_parts(df, [F.col(fold) != i for i in range(folds)], features, specs[0].encode)
    names, parts = [f"_prediction{k}" for k in range(len(specs))], []
    for i, prep in enumerate(preps):
        models = fit_linear(specs, prep, df.where(F.col(fold) != i), label)
        held = predictions(models, df.where(F.col(fold) == i), names)
        scores = F.array(*[F.struct(*_fold_score(spec, i, label, name)) for spec, name in zip(specs, names)])
        parts.append(held.agg(scores.alias("scores")).select(F.inline("scores")))
    return union_by_name(*parts)


def cross_validate_best(board: DataFrame, specs: Sequence[ModelSpec], df: DataFrame, features: Sequence[str], label: str,
                        fold: str, folds: int = 3, best: int = 3) -> DataFrame:
    """Mean and population deviation of the folds' R2 for the ``best`` models of a leaderboard, highest mean first."""
    names = [row["model"] for row in board.orderBy(F.desc("val_r2"), "model").limit(best).select("model").collect()]
    chosen = [spec for spec in specs if spec.name in names]
    encodings = dict.fromkeys(spec.encode for spec in chosen if spec.linear)
    scores = [cross_validate_linear([x for x in chosen if x.linear and x.encode == encode], df, features, label, fold, folds) for encode in encodings]
    scores += [cross_validate(spec, df, features, label, fold, folds) for spec in chosen if not spec.linear]
    return union_by_name(*scores).groupBy("model").agg(
        F.count("r2_log").alias("folds"), F.avg("r2_log").alias("mean_r2"), F.stddev_pop("r2_log").alias("std_r2")
    ).orderBy(F.desc("mean_r2"), "model")


def feature_importance(model: PipelineModel, names: Sequence[str], df: DataFrame) -> DataFrame:
    """Importances of a tree model, largest first; one row per vector entry."""
    last = model.stages[-1]
    values = last.importances if hasattr(last, "importances") else last.featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def save(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def compare(specs: Sequence[ModelSpec], train: DataFrame, val: DataFrame, features: Sequence[str],
            label: str, price: str) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit all, report all: (leaderboard, fitted models by name)."""
    models, reports = {}, []
    for encode in dict.fromkeys(spec.encode for spec in specs if spec.linear):
        some = [spec for spec in specs if spec.linear and spec.encode == encode]
        fitted = fit_linear(some, preprocess(train, features, encode), train, label)
        models |= {spec.name: model for spec, model in zip(some, fitted)}
        reports += [_linear_report(some, fitted, part, df, label, price) for part, df in (("train", train), ("val", val))]
    for spec in specs:
        if not spec.linear:
            models[spec.name], _ = fit(spec, train, features, label, val)
            reports.append(model_report(spec, models[spec.name], train, val, label, price))
    return leaderboard(union_by_name(*reports)), {spec.name: models[spec.name] for spec in specs}


def _linear_report(specs: Sequence[ModelSpec], models: Sequence[PipelineModel], part: str, df: DataFrame, label: str, price: str) -> DataFrame:
    """``model_report`` of several models behind the same preprocessing for one part, in one scan."""
    names = [f"_prediction{k}" for k in range(len(specs))]
    scored = predictions(models, df, names).withColumns({f"{name}_price": F.expm1(name) for name in names})
    rows = F.array(*[
        F.struct(F.lit(spec.name).alias("model"), F.lit(spec.kind).alias("kind"), F.lit(part).alias("part"), *metric_columns(label, name, price, f"{name}_price"))
        for spec, name in zip(specs, names)
    ])
    return scored.agg(rows.alias("rows")).select(F.inline("rows"))
