"""Adds columns computed from a text column, one Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructType

#: Rows handed to a function at once; bounds what Python holds beside the batch.
ROWS = 1024


def add_columns(
    df: DataFrame,
    text: str,
    added: str,
    factory: Callable[[], Callable[[list], Sequence]],
    keep: Sequence[str] | None = None,
    where: str | None = None,
) -> DataFrame:
    """Columns ``keep`` (all by default) of ``df`` and the ``added`` ones.

    ``factory`` is called once in each task and returns a function from a list of
    texts (None for null) to one sequence for each added column. ``where`` names
    an added boolean column: only rows where it is true are returned, and without
    the added columns. Nothing is shuffled; an empty table gives an empty result.
    """
    keep = list(df.columns if keep is None else keep)
    fields = [df.schema[c] for c in keep]
    new = StructType.fromDDL(added).fields
    schema = to_arrow_schema(StructType(fields + new), prefers_large_types=False)
    types = [schema.field(len(fields) + i).type for i in range(len(new))]
    filtered = [f.name for f in new].index(where) if where else None
    columns, at = [F.col(f"`{c}`") for c in keep], len(keep)
    if text in keep and df.schema[text].dataType == StringType():
        at = keep.index(text)  # sent to Python once
    else:
        columns.append(F.col(text).cast("string").alias("_text_"))
    source = df.select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = factory()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                values = function(part.column(at).to_pylist())
                kept = [part.column(i) for i in range(len(keep))]
                if filtered is not None:
                    rows = pa.RecordBatch.from_arrays(kept, names=keep)
                    yield rows.filter(pa.array(values[filtered], pa.bool_()))
                    continue
                computed = [pa.array(v, t) for v, t in zip(values, types, strict=True)]
                yield pa.RecordBatch.from_arrays(kept + computed, names=keep + [f.name for f in new])

    result = StructType(fields if where else fields + new)
    return source.mapInArrow(run, result)
