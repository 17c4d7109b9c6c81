"""Saved encoder stages: the loaded pipeline gives the same rows, in a batch and in a stream."""

import os

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import functions as F

from tabularis.operators.stages import CodeEstimator, FillEstimator

ROWS = [(k, None if k % 7 == 0 else float(k % 11), None if k % 5 == 0 else "abc"[k % 3], float(k % 11 > 5)) for k in range(120)]


def test_saved_pipeline_serves_batch_and_stream(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "id long, amount double, kind string, label double")
    stages = [FillEstimator(medians=["amount"], modes=["kind"]), CodeEstimator(inputCol="kind", outputCol="code"), OneHotEncoder(inputCol="code", outputCol="hot", handleInvalid="keep")]
    stages += [VectorAssembler(inputCols=["amount", "hot"], outputCol="features"), LogisticRegression(maxIter=20)]
    model = Pipeline(stages=stages).fit(df)
    path = str(tmp_path / "model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    new = df.unionByName(spark.createDataFrame([(1000, None, "never seen", 0.0), (1001, 2.0, None, 1.0)], df.schema))
    rows = lambda d: {r["id"]: (r["amount"], r["kind"], r["code"], round(r["probability"][1], 12)) for r in d.select("id", "amount", "kind", "code", "probability").collect()}
    want = rows(model.transform(new))
    assert rows(loaded.transform(new)) == want and want[1000][2] == 3.0 and want[1001][1] == "a"
    assert want[0][0] == df.select(F.median("amount")).first()[0]
    new.write.parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp"))
    query.foreachBatch(lambda d, n: loaded.transform(d).write.mode("overwrite").parquet(os.path.join(out, str(n)))).start().awaitTermination(120)
    assert rows(spark.read.parquet(f"{out}/*")) == want


def test_empty_and_null_columns(spark):
    df = spark.createDataFrame([(1, None, None)], "id long, amount double, kind string")
    filled = FillEstimator(medians=["amount"], modes=["kind"]).fit(df).transform(df)
    coded = CodeEstimator(inputCol="kind", outputCol="code").fit(df).transform(filled).first()
    assert (coded["amount"], coded["kind"], coded["code"]) == (None, None, 0.0)
