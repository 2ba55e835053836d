"""Rows mapped through a heavy resource that every Python worker makes once.

For a user's own lemmatizer, tagger or tokenizer: something that is slow to build and cannot be sent
to executors. ``factory`` is sent instead; the first batch that a worker process gets makes the
resource, and all later batches, tasks and jobs that the same worker runs for the same mapping use
it again. Rows keep their columns, partitions and order.
"""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, StructField, StructType, _parse_datatype_string

#: The module, known to a worker process only, that holds its resources.
_HOLDER = "_quire_worker_resources"


def with_resource(df: DataFrame, factory: Callable[[], Any], apply: Callable[[Any, list], list], in_col: str, out_col: str,
                  out_type: str | DataType, batch_rows: int = 256) -> DataFrame:
    """``df`` and ``out_col``: ``apply(resource, values)`` of ``in_col``, in batches of at most ``batch_rows`` values.

    ``apply`` returns one value for each it is given, nulls among them. ``out_col`` replaces a column of
    that name. Both functions travel by value if they are lambdas or of the caller's script.
    """
    kind = _parse_datatype_string(out_type) if isinstance(out_type, str) else out_type
    kept = [f for f in df.schema.fields if f.name != out_col]
    schema = StructType([*kept, StructField(out_col, kind)])
    names = [f.name for f in kept]
    token = uuid.uuid4().hex
    holder_name = _HOLDER

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        arrow = to_arrow_type(kind)
        holder = sys.modules.setdefault(holder_name, types.ModuleType(holder_name))
        held = holder.__dict__.setdefault("held", {})
        for whole in batches:
            for at in range(0, whole.num_rows, batch_rows):
                batch = whole.slice(at, batch_rows)
                if token not in held:
                    held[token] = factory()
                values = batch.column(batch.schema.get_field_index(in_col)).to_pylist()
                out = apply(held[token], values)
                if len(out) != len(values):
                    raise ValueError(f"{len(out)} values for {len(values)} rows")
                columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(out, arrow)], [*names, out_col])

    return df.mapInArrow(run, schema)
