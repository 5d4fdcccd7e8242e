"""Exports that say how sensitive they are."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.vocabulary import CLASSIFICATIONS, strictest


def classification_of(df: DataFrame) -> str:
    """The highest classification any column carries; the lowest level without tags."""
    levels = [f.metadata.get("classification") for f in df.schema.fields]
    return strictest(levels, CLASSIFICATIONS) or CLASSIFICATIONS[0]


def export_with_header(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """Write CSV or JSON text whose part files each start with a classification line."""
    header = f"# classification: {classification_of(df)}"
    if fmt == "csv":
        body = F.to_csv(F.struct(*df.columns))
        opening = [header, ",".join(df.columns)]
    elif fmt == "json":
        body = F.to_json(F.struct(*df.columns))
        opening = [header]
    else:
        raise ValueError(f"unknown format {fmt!r}")

    def with_opening(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One pass per part file: the opening lines, then the rows as they come.
        yield pa.RecordBatch.from_pydict({"value": opening})
        yield from batches

    df.select(body.alias("value")).mapInArrow(with_opening, "value string").write.mode(
        "overwrite"
    ).text(path)
    return path
