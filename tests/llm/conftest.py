from __future__ import annotations

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def table(spark, tmp_path):
    """Writes rows as a table and reads it: the sources are files, as in production."""

    def write(rows, schema, name="t", files=2):
        path = f"file://{tmp_path}/{name}"
        spark.createDataFrame(rows, schema).repartition(files).write.parquet(path)
        return spark.read.parquet(path)

    return write
