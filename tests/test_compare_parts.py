"""The model comparison hands its classifiers all lines in few parts."""

from pyspark.ml.classification import LogisticRegression

from lexstrata.operators import evaluate as E


def test_few_parts(spark, monkeypatch):
    seen = []

    class Spy(LogisticRegression):
        def fit(self, rows):
            seen.append((rows.rdd.getNumPartitions(), rows.count()))
            return super().fit(rows)

    monkeypatch.setattr(E, "classifiers", lambda: {"m": Spy(maxIter=1, labelCol="label", featuresCol="features", weightCol="weight")})
    rows = spark.createDataFrame([(i, f"line {'good' if i % 2 else 'bad'} {i % 7}{i % 3}", float(i % 2)) for i in range(40)], "line_id long, text string, label double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        E.compare(rows, ("m",))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert seen == [(1, 32)]
