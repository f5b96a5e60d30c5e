from pyspark.sql import functions as F

from lexrev.operators import textmodel as TM


def test_text_models_train_and_score(spark):
    rows = []
    for i in range(40):
        good = i % 2 == 0
        rows.append((i, ("board meeting shareholders agreement capital " if good else "spam lottery winner click ") * 3))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2 == 0).cast("int").alias("quality"))
    for algo in TM.ALGOS:
        model = TM.train_text_model(docs, labels, label="quality", algo=algo)
        out = TM.score_text_model(model, docs).join(labels, "doc_id")
        acc = out.where(F.col("prediction") == F.col("quality")).count() / out.count()
        assert acc == 1.0, algo
