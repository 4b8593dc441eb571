"""Text classification of articles (R4): hashed words, inverse document frequency, logistic regression.

The stages are a Spark ML pipeline: fitted by passes over the labelled rows in the
tasks, stored as a folder, loaded and applied anywhere. Its inputs are the hashed
counts that vectors are made of (V1), without scaling to length 1.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

# Most labelled rows that a model is fitted on.
SAMPLE_ROWS = 50_000
_TEXT = "_text"
# What the words alone do not tell: length, variety of words, share of characters that are no letters.
_SHAPE = {
    "_length": "ln(1 + size(_words)) / 5",
    "_variety": "size(array_distinct(_words)) / greatest(1, size(_words))",
    "_odd": r"1 - length(regexp_replace(_text, '[^\\p{L}\\s]', '')) / greatest(1, length(_text))",
}


def held_out(key: Column) -> Column:
    """One row in five, by the checksum of its key, is kept from fitting."""
    return F.crc32(key.cast("string")) % 5 == 0


def drawn(labelled: DataFrame, key: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most `rows` rows in the order of their key's hash, the same on every run.

    The keys are drawn alone and then met with the rows: at most `rows` of them, so
    they are broadcast and no text is shuffled.
    """
    order = F.xxhash64(key)
    keys = labelled.select(key).distinct().orderBy(order, key).limit(rows)
    return labelled.join(F.broadcast(keys), key, "left_semi")


def pipeline(dim: int = 1 << 16, strength: float = 1e-4, steps: int = 60) -> Pipeline:
    """Words as of V1, `dim` hashed counts, their inverse document frequency, length 1, the text's shape, a linear model."""
    shape = ", ".join(f"{sql} AS {name}" for name, sql in _SHAPE.items())
    return Pipeline(stages=[
        RegexTokenizer(inputCol=_TEXT, outputCol="_words", pattern=r"[\s\p{Punct}]+", toLowercase=True),
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dim),
        IDF(inputCol="_counts", outputCol="_weighted", minDocFreq=2),
        Normalizer(inputCol="_weighted", outputCol="_unit"),
        SQLTransformer(statement=f"SELECT *, {shape} FROM __THIS__"),
        VectorAssembler(inputCols=["_unit", *_SHAPE], outputCol="_features"),
        LogisticRegression(
            featuresCol="_features", labelCol="_label", weightCol="_weight", probabilityCol="_probability",
            rawPredictionCol="_raw", predictionCol="_prediction", regParam=strength, maxIter=steps, standardization=False),
    ])


def fit_classifier(labelled: DataFrame, text: str, label: str, **settings) -> PipelineModel:
    """A model of `label` (0, 1, ... up to the number of classes) from `text`.

    Classes weigh the same whatever their share. A null text is an empty one; rows
    without a label are left out; fewer than two classes are an error.
    """
    rows = labelled.filter(F.col(label).isNotNull()).select(
        F.coalesce(text, F.lit("")).alias(_TEXT), F.col(label).cast("double").alias("_label"))
    # labels alone are counted: as many rows as classes come back
    counts = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        raise ValueError(f"a classifier needs two classes, got {sorted(counts)}")
    total = sum(counts.values())
    weight = F.lit(None).cast("double")
    for value, n in counts.items():
        weight = F.when(F.col("_label") == value, total / (len(counts) * n)).otherwise(weight)
    return pipeline(**settings).fit(rows.withColumn("_weight", weight))


def classify(df: DataFrame, model: PipelineModel, text: str, output: str = "label") -> DataFrame:
    """`df` with the likeliest class in `output` and its probabilities in `<output>_scores`."""
    out = model.transform(df.withColumn(_TEXT, F.coalesce(text, F.lit(""))))
    return out.withColumns({
        output: F.col("_prediction").cast("int"), f"{output}_scores": vector_to_array("_probability"),
    }).select(*df.columns, output, f"{output}_scores")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
