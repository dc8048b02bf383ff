"""Line classifiers: splits, features, models, metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, CountVectorizer, IDF, NGram, Normalizer, RegexTokenizer, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def clean_label(c: Column) -> Column:
    """1.0 for positive, 0.0 for negative, in any case and with spaces around; null otherwise."""
    t = F.lower(F.trim(c))
    return F.when(t == "positive", 1.0).when(t == "negative", 0.0)


def class_balance(rows: DataFrame) -> DataFrame:
    """sentiment, count of a table of labelled lines."""
    return rows.groupBy("sentiment").agg(F.count("*").alias("count"))


BUCKETS, CUTS = 4096, 500
PART = 50_000


def stratified_split(rows: DataFrame, label: str, key: str, share: float = 0.8, seed: int = 42) -> DataFrame:
    """Add is_train: an exact share of each label (rounded up), by the order of a hash of key; reproducible.

    A label may hold most rows: they are counted by label and hash bucket, and only rows of the bucket in which the share
    ends are ranked. No task sees more than a bucket."""
    rows = rows.withColumn("_h", F.xxhash64(F.lit(seed), key)).withColumn("_b", F.pmod("_h", F.lit(BUCKETS)))
    counts = rows.groupBy(label, "_b").agg(F.count("*").alias("_n"))  # at most BUCKETS rows a label
    w = Window.partitionBy(label)
    want = F.ceil(F.sum("_n").over(w) * share)
    before = F.sum("_n").over(w.orderBy("_b")) - F.col("_n")
    left = counts.select(F.col(label).alias("_l"), F.col("_b").alias("_c"), (want - before).alias("_left"), "_n")
    rows = rows.join(F.broadcast(left), F.col(label).eqNullSafe(F.col("_l")) & (F.col("_b") == F.col("_c")))
    split = (F.col("_left") > 0) & (F.col("_left") < F.col("_n"))
    rank = F.row_number().over(Window.partitionBy(label, "_b").orderBy("_h", key))
    return rows.withColumn("is_train", F.when(split, rank <= F.col("_left")).otherwise(F.col("_left") > 0)).drop("_h", "_b", "_l", "_c", "_left", "_n")


def metrics(rows: DataFrame) -> DataFrame:
    """One row: accuracy, precision, recall, f1, auc, tn, fp, fn, tp. rows: label, prediction, score.

    Undefined ratios are null but precision, recall and f1, which are 0 then. auc: the rank formula with tied scores at
    their mean rank, over distinct scores: each has its counts of both labels, and the number of negatives below it. That
    number is the sum over lower buckets of scores, and a running sum within a bucket."""
    y, p = F.col("label") == 1, F.col("prediction") == 1
    by = rows.groupBy("score").agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"), F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    # Buckets of about as many rows each, also where scores are packed: bounded by CUTS numbers.
    cuts = sorted(set(rows.where("score IS NOT NULL").approxQuantile("score", [i / CUTS for i in range(1, CUTS)], 0.5 / CUTS)))
    splits = [-float("inf"), *cuts, float("inf")]
    by = Bucketizer(splits=splits, inputCol="score", outputCol="bucket", handleInvalid="keep").transform(by) if cuts else by.withColumn("bucket", F.lit(0.0))
    sums = by.groupBy("bucket").agg(F.sum("neg").alias("n"))  # at most CUTS + 1 rows
    sums = sums.select("bucket", (F.sum("n").over(Window.partitionBy(F.lit(1)).orderBy("bucket")) - F.col("n")).alias("lower"))
    within = F.sum("neg").over(Window.partitionBy("bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, -1))
    by = by.join(F.broadcast(sums), "bucket").withColumn("below", F.col("lower") + F.coalesce(within, F.lit(0)))
    by = by.withColumn("wins", F.col("pos") * (F.col("below") + F.col("neg") / 2))
    s = by.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn", "tn", "pos", "neg", "wins")])
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return s.select(
        F.try_divide(tp + tn, tp + tn + fp + fn).alias("accuracy"), ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        F.try_divide("wins", F.col("pos") * F.col("neg")).alias("auc"), "tn", "fp", "fn", "tp",
    )


def class_report(rows: DataFrame) -> DataFrame:
    """label, precision, recall, f1, support: a row for each label, of rows with label and prediction. Undefined ratios are 0."""
    both = rows.select(F.col("label").cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction")).where("label IS NOT NULL AND prediction IS NOT NULL")
    sides = F.array(F.struct(F.col("label").alias("of"), F.lit(1).alias("is"), F.lit(0).alias("said")), F.struct(F.col("prediction").alias("of"), F.lit(0).alias("is"), F.lit(1).alias("said")))
    counts = both.withColumn("hit", (F.col("label") == F.col("prediction")).cast("int")).select("hit", F.explode(sides).alias("s"))
    counts = counts.groupBy(F.col("s.of").alias("label")).agg(F.sum(F.col("s.is") * F.col("hit")).alias("tp"), F.sum("s.is").cast("long").alias("support"), F.sum("s.said").alias("said"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, n, said = (F.col(c) for c in ("tp", "support", "said"))
    return counts.select("label", ratio(tp, said).alias("precision"), ratio(tp, n).alias("recall"), ratio(2 * tp, n + said).alias("f1"), "support")


def evaluate_scorer(rows: DataFrame, scorer, threshold: float = 0.5) -> DataFrame:
    """metrics of a scorer (a function from a text column to a score column) over rows with text and label."""
    scored = rows.where("text IS NOT NULL AND label IS NOT NULL").select("label", scorer(F.col("text")).cast("double").alias("score"))
    return metrics(scored.select("label", (F.col("score") >= threshold).cast("double").alias("prediction"), "score"))


def features(size: int = 10_000, least: int = 2, most: float = 0.95) -> list:
    """Stages: words, their pairs, TF-IDF over the size most frequent, unit length. Input column: text."""
    return [
        RegexTokenizer(inputCol="text", outputCol="words", pattern=r"(?U)\w{2,}", gaps=False),
        NGram(n=2, inputCol="words", outputCol="pairs"),
        SQLTransformer(statement="SELECT *, concat(words, pairs) AS grams FROM __THIS__"),
        CountVectorizer(inputCol="grams", outputCol="counts", vocabSize=size, minDF=least, maxDF=most),
        IDF(inputCol="counts", outputCol="weights"),
        Normalizer(inputCol="weights", outputCol="features", p=2.0),
    ]


def classifiers() -> dict[str, object]:
    """Spark ML has no RBF kernel and no probabilities for an SVM: a linear one stands for it."""
    common = {"labelCol": "label", "featuresCol": "features", "weightCol": "weight"}
    return {
        "Logistic Regression": LogisticRegression(maxIter=1000, **common),
        "Linear SVM": LinearSVC(maxIter=1000, **common),
        "Random Forest": RandomForestClassifier(numTrees=100, maxDepth=10, seed=42, **common),
    }


def balanced(rows: DataFrame) -> DataFrame:
    """Add weight: inverse to the label's share."""
    counts = rows.groupBy("label").agg(F.count("*").alias("_n"))  # a row a label
    weights = counts.select("label", (F.sum("_n").over(Window.partitionBy(F.lit(1))) / (2 * F.col("_n"))).alias("weight"))
    return rows.join(F.broadcast(weights), "label")


def in_parts(rows: DataFrame) -> DataFrame:
    """All rows in parts of about PART lines. A fit reads them in up to a thousand steps, each a job: of few lines a step
    costs what its tasks cost to start, and over four parts or fewer their sums need no exchange."""
    return rows.repartition(max(1, -(-rows.count() // PART)), "line_id")


@dataclass
class Comparison:
    metrics: DataFrame
    models: dict[str, PipelineModel]
    class_reports: DataFrame
    info: DataFrame


def score_column(model: PipelineModel, scored: DataFrame) -> Column:
    if "probability" in scored.columns:
        return vector_to_array("probability")[1]
    return vector_to_array("rawPrediction")[1]


def compare(rows: DataFrame, names: tuple[str, ...] = ("Logistic Regression", "Linear SVM", "Random Forest")) -> Comparison:
    """Fit the named models on all training lines, evaluate each on all test lines; best f1 first, equal
    ones in the order of names, as the reference has them.

    rows: line_id, text, label. Vocabulary, document frequencies and class weights are those of all training lines too."""
    rows = stratified_split(rows, "label", "line_id")
    train = balanced(rows.where("is_train"))
    prepared = Pipeline(stages=features()).fit(train)
    fit, test = (in_parts(prepared.transform(x).select("line_id", "label", *more, "features")).drop("line_id").cache() for x, more in ((train, ["weight"]), (rows.where("NOT is_train"), [])))
    out, reports, models = None, None, {}
    for name in names:
        model = classifiers()[name].fit(fit)
        scored = model.transform(test)
        found = metrics(scored.select("label", "prediction", score_column(model, scored).alias("score"))).select(F.lit(name).alias("model"), "*")
        by_class = class_report(scored).select(F.lit(name).alias("model"), "*")
        out = found if out is None else out.unionByName(found)
        reports = by_class if reports is None else reports.unionByName(by_class)
        models[name] = PipelineModel(stages=[*prepared.stages, model])
    info = rows.agg(F.count_if("is_train").alias("train_samples"), F.count_if(~F.col("is_train")).alias("test_samples"))
    return Comparison(out.orderBy(F.desc("f1"), F.array_position(F.lit(list(names)), F.col("model"))), models, reports.orderBy("model", "label"), info)
