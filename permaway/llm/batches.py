"""Size of the batches of texts that Python workers get."""

from __future__ import annotations

from pyspark.sql import DataFrame

ROWS, BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


def text_batches(docs: DataFrame, rows: int = 1000, size: int = 8 << 20) -> DataFrame:
    """docs, after limiting the session's Arrow batches to so many rows and bytes unless they are
    smaller already: a worker holds a batch as a whole, and texts are long."""
    conf = docs.sparkSession.conf
    for key, most in ((ROWS, rows), (BYTES, size)):
        now = conf.get(key).rstrip("b")
        if now.isdigit() and not 0 < int(now) <= most:
            conf.set(key, str(most))
    return docs
