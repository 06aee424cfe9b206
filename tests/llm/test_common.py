from __future__ import annotations

from windrow.llm import common


def test_the_filter_lets_every_id_pass(spark):
    ids = spark.range(0, 30_000, 7).withColumnRenamed("id", "doc_id")
    bits = common.id_filter(ids, "doc_id")
    places = ids.select(common.filter_place("doc_id").alias("p")).toPandas()["p"].to_numpy()
    assert common.passes(bits, places).all()


def test_stored_rows_and_shared_folder(spark):
    assert common.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert common.stored(spark.range(5), "test").count() == 5
