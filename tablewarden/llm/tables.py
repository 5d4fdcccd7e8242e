"""Reading the given tables and running Arrow functions over text columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.context import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def map_batches(
    df: DataFrame,
    ddl: str,
    make: Callable[[], Callable[[pa.RecordBatch], dict | Iterator[dict]]],
) -> DataFrame:
    """Run `make()` once in each task, and what it returns on each Arrow batch.

    The inner function gives the columns that `ddl` names, as lists or arrays, at
    once or part by part.
    """
    ship_package(df.sparkSession)
    schema = T.StructType.fromDDL(ddl)
    arrow = pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            found = step(batch)
            for columns in [found] if isinstance(found, dict) else found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow
                )
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def pa_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8; null is empty."""
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    return [v or b"" for v in values.to_pylist()]


def slices(batch: pa.RecordBatch, sizes: Iterable[int], limit: int) -> Iterator[pa.RecordBatch]:
    """Runs of a batch's rows whose `sizes` make about `limit` together; a larger row stands alone."""
    begin = size = 0
    for i, own in enumerate(sizes):
        if size and size + own > limit:
            yield batch.slice(begin, i - begin)
            begin, size = i, 0
        size += own
    if begin < batch.num_rows:
        yield batch.slice(begin)


def text_slices(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """Runs of a batch's rows with about `limit` bytes of text; a longer text stands alone."""
    lengths = pc.binary_length(batch.column(batch.schema.get_field_index("text")))
    return slices(batch, pc.fill_null(lengths, 0).to_pylist(), limit)


def held_out(doc_id: str = "doc_id"):
    """Rows never learned from: crc32 of the id as text leaves no remainder by five."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
