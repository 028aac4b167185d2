"""Python helpers applied to Arrow batches, a few rows at a time.

Functions of this folder travel to the workers by value, so executors need no copy
of the package; what a worker should keep between tasks (a loaded tokenizer, a
bounded cache) is held by ``kept``.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

import spindle.llm

cloudpickle.register_pickle_by_value(spindle.llm)


def kept(key: tuple, make: Callable):
    """The object that ``make`` made for ``key`` in this worker process."""
    store = sys.__dict__.setdefault("_spindle_worker_objects", {})
    if key not in store:
        store[key] = make()
    return store[key]


#: Arrow types by the names used in DDL.
ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
         "binary": pa.binary(), "boolean": pa.bool_()}

#: Rows and text characters handed to Python at a time; a longer text comes alone, whole.
SLICE_ROWS, SLICE_CHARS = 256, 4_000_000


def _slices(batch: pa.RecordBatch, text_at: int) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of consecutive rows; null counts as empty."""
    start, texts, chars = 0, [], 0
    for i, value in enumerate(batch.column(text_at)):
        text = value.as_py() or ""
        if texts and (len(texts) == SLICE_ROWS or chars + len(text) > SLICE_CHARS):
            yield start, texts
            start, texts, chars = i, [], 0
        texts.append(text)
        chars += len(text)
    if texts:
        yield start, texts


def with_python_columns(df: DataFrame, text_col: str, fields: dict[str, str],
                        make: Callable[[], Callable[[list[str]], list[list]]]) -> DataFrame:
    """``df`` plus ``fields`` (name -> DDL type) computed from its text, row by row in the
    same order. ``make`` runs once a task and returns the function from texts to columns.
    A column of ``df`` named like a field is replaced; the text column may be too."""
    lower = {f.lower() for f in fields}
    own = [c for c in df.columns if c.lower() not in lower]
    read = df.select(*own, df[text_col].cast("string").alias("__text"))
    schema = ", ".join([*(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.select(*own).schema),
                        *(f"`{n}` {t}" for n, t in fields.items())])
    types = [ARROW.get(t) or to_arrow_type(DataType.fromDDL(t)) for t in fields.values()]

    def run(batches):
        apply = make()
        for batch in batches:
            for start, texts in _slices(batch, len(own)):
                part = batch.slice(start, len(texts))
                made = [pa.array(c, t) for c, t in zip(apply(texts), types, strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(own))), *made],
                                                 [*own, *fields])

    return read.mapInArrow(run, schema)
