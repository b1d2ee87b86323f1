from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from rollmatch.llm.common import BATCH_BYTES, small_batches


def test_batches_are_bounded_by_bytes(spark):
    small_batches(spark)

    def size(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([texts.nbytes] * len(texts), pa.int64())

    texts = spark.range(40, numPartitions=1).select(F.repeat(F.lit("x"), 2_000_000).alias("t"))
    largest = texts.select(F.arrow_udf(size, "long")("t").alias("n")).agg(F.max("n")).first()[0]
    assert 2_000_000 <= largest <= BATCH_BYTES + 2 * 2_000_000
