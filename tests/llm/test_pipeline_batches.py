"""The pipeline's stages hand texts to Python in small batches."""

import corpus_pipeline
import pyarrow as pa


def test_stages_get_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        stage = corpus_pipeline._stage(lambda spark, docs, sf_dir: docs.mapInArrow(sizes, "n long"))
        found = [r["n"] for r in stage(spark, spark.range(0, 5000, 1, 1), "").collect()]
    finally:
        spark.conf.set(key, before)
    assert sum(found) == 5000 and max(found) <= 1000
