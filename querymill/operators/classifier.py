"""Linear classifier: training, prediction, batch scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    IndexToString,
    SQLTransformer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from querymill.operators.columns import drop_label, prediction_only
from querymill.session import materialize
from querymill.sinks.files import write_predictions
from querymill.sources.files import scan_declared

# The training parameters in use.
INVERSE_PENALTY = 1.23456
MAX_ITERATIONS = 987
N_FEATURES = 4

REPEATS = 8  # rows for each distinct one, from which equal rows are joined before a fit


def train_classifier(
    df: DataFrame,
    label: str = "species",
    n_features: int = N_FEATURES,
    inverse_penalty: float = INVERSE_PENALTY,
    max_iterations: int = MAX_ITERATIONS,
    tolerance: float = 1e-8,
    max_classes: int = 10_000,
) -> PipelineModel:
    """Fit L2-penalised logistic regression of ``label`` on the first columns.

    Minimises half the squared weights plus ``inverse_penalty`` times the summed
    log-loss, intercepts free: softmax for three or more classes, one weight
    vector for two. Spark averages the loss over the rows, hence the penalty
    1 / (inverse_penalty * rows) on unscaled features.

    A label column with more than ``max_classes`` values is refused: their counts and
    weights come to the driver. One pass counts the rows per class; the fit is then a series
    of distributed aggregations over a copy that Spark keeps in memory and on disk. Where
    the first pass finds few distinct rows, equal ones are one row with a weight, which
    gives the same sums. Only class counts and weights come to the driver.
    """
    features = df.columns[:n_features]
    distinct = F.approx_count_distinct(F.xxhash64(*[F.col(f"`{c}`") for c in features]))
    per_class = materialize(
        df.groupBy(F.col(f"`{label}`").cast("string").alias("label")).agg(
            F.count("*").alias("count"), distinct.alias("distinct")
        ),
        "classes",
    )
    n_classes = per_class.where("label IS NOT NULL").count()
    if not 2 <= n_classes <= max_classes:
        raise ValueError(f"{label} has {n_classes} classes, need 2 to {max_classes}")
    found = per_class.collect()
    counts = {row["label"]: row["count"] for row in found}
    if None in counts:
        raise ValueError(f"{label} has missing values")
    classes = sorted(counts)

    assembler = VectorAssembler(
        inputCols=features, outputCol="_features", handleInvalid="error"
    )
    indexer = StringIndexerModel.from_labels(
        classes, inputCol="_label_text", outputCol="_label", handleInvalid="error"
    )
    regression = LogisticRegression(
        featuresCol="_features",
        labelCol="_label",
        predictionCol="_class",
        probabilityCol="_probability",
        rawPredictionCol="_raw",
        family="binomial" if len(classes) == 2 else "multinomial",
        regParam=1.0 / (inverse_penalty * sum(counts.values())),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iterations,
        tol=tolerance,
    )
    text = F.col(f"`{label}`").cast("string").alias("_label_text")
    labelled = df.select(*[F.col(f"`{c}`") for c in features], text)
    if REPEATS * sum(row["distinct"] for row in found) < sum(counts.values()):
        regression.setWeightCol("_weight")
        named = [F.col(f"`{c}`") for c in labelled.columns]
        labelled = labelled.groupBy(*named).agg(F.count("*").cast("double").alias("_weight"))
    rows = indexer.transform(assembler.transform(labelled))
    fitted = regression.fit(rows.drop(*features, "_label_text"))
    stages = [
        assembler,
        fitted,
        IndexToString(inputCol="_class", outputCol="predicted_score", labels=classes),
    ]
    label_type = df.schema[label].dataType
    if label_type != StringType():
        stages[-1].setOutputCol("_class_text")
        stages.append(
            SQLTransformer(
                statement=f"SELECT *, CAST(_class_text AS {label_type.simpleString()}) "
                "AS predicted_score FROM __THIS__"
            )
        )
    return PipelineModel(stages)


def predict(
    model: PipelineModel,
    df: DataFrame,
    key_cols: Sequence[str] = (),
    label: str = "species",
) -> DataFrame:
    """Predicted label of each row as ``predicted_score``.

    Rows have no position in Spark; ``key_cols`` says which row is which.
    """
    return prediction_only(model.transform(drop_label(df, label)), key_cols)


def batch_score(
    spark: SparkSession,
    model: PipelineModel,
    input_prefix: str,
    output_path: str,
    *,
    declared: str = "application/x-parquet",
    accept: str = "application/x-parquet",
    schema: StructType | None = None,
    key_cols: Sequence[str] = (),
    label: str = "species",
    multiline: bool = True,
    own_csv: bool = False,
) -> None:
    """Score every file under a prefix into Parquet: one pass, no shuffle.

    ``multiline`` and ``own_csv`` as in ``scan_prefix``.
    """
    rows = scan_declared(
        spark, input_prefix, declared, schema, multiline=multiline, own_csv=own_csv
    )
    write_predictions(predict(model, rows, key_cols, label), output_path, accept)
