"""Tags kept as a JSON object in a text column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tag_names(df: DataFrame, tags: str = "tags") -> list[str]:
    """All names that occur, sorted: one aggregate, whose result is one row per name."""
    names = df.select(F.explode(F.json_object_keys(tags)).alias("name")).distinct()
    return sorted(row["name"] for row in names.collect())


def first_record_keys(df: DataFrame, order: str, tags: str = "tags") -> list[str]:
    """Names in the first record by ``order`` that has tags: one row is fetched."""
    named = df.select(order, F.json_object_keys(tags).alias("names")).filter("names IS NOT NULL")
    first = named.orderBy(order).first()
    return list(first["names"]) if first else []


def flatten_tags(df: DataFrame, keys: Sequence[str] | None = None, tags: str = "tags") -> DataFrame:
    """Replace the tag column by one text column per key; missing tags stay NULL. Without ``keys``
    all names that occur become columns, in text order."""
    names = list(keys) if keys is not None else tag_names(df, tags)
    parsed = df.withColumn(tags, F.from_json(tags, "map<string,string>"))
    return parsed.select(
        *[c for c in df.columns if c != tags], *[F.col(tags)[name].alias(name) for name in names]
    )
