"""Columns made from texts beside carried columns that stay Arrow arrays.

A pandas column of whole numbers turns into floating point as soon as a null stands in its batch, which changes keys of over 53 bits.
Here only the columns that a function works on become Python values; all others go through as they came.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

#: From one list of values for each given column to one list for each made column.
Make = Callable[..., list[list]]


def with_made(docs: DataFrame, carry: list[str], given: list[Column], added: str, start: Callable[[], Make]) -> DataFrame:
    """The columns ``carry`` and the columns that ``added`` declares, a row for each row.

    ``start`` is called once in each task; what it returns is called for each Arrow batch. Carried columns go through by place, so their names
    can't clash with anything; their values and nulls stay as they are, whatever their types.
    """
    held = docs.select(*[docs[f"`{c}`"].alias(f"_c{i}") for i, c in enumerate(carry)], *[g.alias(f"_g{i}") for i, g in enumerate(given)])
    kept, made = list(held.schema[: len(carry)]), StructType.fromDDL(added)
    schema = StructType(kept + list(made))
    names, n, n_given = [f.name for f in schema], len(carry), len(given)
    kinds = [to_arrow_type(f.dataType) for f in made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = start()
        for batch in batches:
            new = make(*[batch.column(n + i).to_pylist() for i in range(n_given)])
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(n)] + [pa.array(x, type=k) for x, k in zip(new, kinds, strict=True)], names=names)

    out = held.mapInArrow(run, schema)
    return out.select(*[out[f"_c{i}"].alias(c) for i, c in enumerate(carry)], *[f.name for f in made])
