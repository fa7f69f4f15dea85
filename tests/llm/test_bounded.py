"""What tasks of op11 hold at once."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tidewatch.llm import collocations, frames


def test_coded_texts_are_worked_on_in_arrays_of_bounded_length():
    rows = [("de", 30), ("en", 50), ("de", 40), ("de", 45), ("en", 300), ("de", 10)]
    codes = [np.append(np.arange(1, n, dtype=np.uint64), np.uint64(0)) for _, n in rows]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([lang for lang, _ in rows]), pa.array([own.tobytes() for own in codes], pa.binary())], ["lang", "codes"])
    found = list(collocations._codes_in(batch, 100))
    assert [(lang, len(own)) for lang, own in found] == [("de", 70), ("de", 55), ("en", 50), ("en", 300)]
    whole = dict(collocations._codes_in(batch, 1 << 20))
    for lang, own in whole.items():
        assert np.concatenate([part for other, part in found if other == lang]).tolist() == own.tolist()


def test_long_rows_are_stored_in_small_blocks(spark):
    rows = spark.range(4000).select(F.concat_ws("", *[F.sha2((F.col("id") * k).cast("string"), 512) for k in range(1, 20)]).alias("x"))
    (name, *_), before = frames.stored(rows.coalesce(1), 1 << 20).inputFiles(), spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")
    assert pq.ParquetFile(name.removeprefix("file://")).num_row_groups > 3
    with frames.small_batches(spark, rows=128):
        assert spark.conf.get("spark.sql.parquet.columnarReaderBatchSize") == "128"
    assert spark.conf.get("spark.sql.parquet.columnarReaderBatchSize") == before
