"""Small helpers for operators that work on Arrow batches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

#: bytes of text that a task holds decoded at once; a longer text forms a slice of its own
SLICE_BYTES = 1 << 20

Work = Callable[[pa.RecordBatch], list]


_CACHES: dict[str, Callable[[], None]] = {}


def own_cache(name: str, clear: Callable[[], None]) -> None:
    """Called as a task starts: empties what other operators' tasks have left in this Python worker, which Spark
    reuses, so that it holds the cache of one operator at a time."""
    for other, forget in list(_CACHES.items()):
        if other != name:
            forget()
            del _CACHES[other]
    _CACHES[name] = clear


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on after its task, beside other stages' tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def sliced(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the text column of a slice has about ``most`` bytes."""
    start = held = 0
    for i, n in enumerate(pc.binary_length(field(batch, column)).to_pylist()):
        if held and held + (n or 0) > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n or 0
    if batch.num_rows > start:
        yield batch.slice(start)


def field(batch: pa.RecordBatch, column: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(column))


def texts(batch: pa.RecordBatch, column: str) -> list[str | None]:
    return field(batch, column).to_pylist()


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """The texts of a column as UTF-8 bytes."""
    return field(batch, column).cast(pa.binary()).to_pylist()


def add_columns(
    df: DataFrame, text_col: str, added: str, make: Callable[[], Work], slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """Keep all columns of ``df`` and add those of the DDL string ``added``.

    ``make()`` runs once per task and returns a function from a batch to one list or array per added
    column. A column of ``df`` that has an added column's name, in any case, is replaced.
    """
    new = StructType.fromDDL(added)
    names = {f.name.lower() for f in new} - {text_col.lower()}
    df = df.drop(*[c for c in df.columns if c.lower() in names])
    schema = StructType(df.schema.fields + new.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        fields = to_arrow_schema(new)
        work = make()
        for whole in batches:
            for batch in sliced(whole, text_col, slice_bytes):
                extra = [
                    values.cast(f.type) if isinstance(values, pa.Array) else pa.array(values, type=f.type)
                    for values, f in zip(work(batch), fields, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(batch.columns + extra, names=batch.schema.names + fields.names)
        del work
        give_back()

    return df.mapInArrow(run, schema)


def beside(docs: DataFrame, own: list[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply ``work`` while all columns but ``own`` have names that no operator uses, and give the columns back."""
    names = docs.columns
    hidden = docs.toDF(*(c if c in own else f"_beside_{i}" for i, c in enumerate(names)))
    return work(hidden).select(hidden.columns).toDF(*names)


def whole_cells(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """Tables with whole cells, and the row range of each cell; rows come sorted by the cells' keys.

    A cell that goes on in the next batch is held back until it is complete.
    """

    def edges(table: pa.Table | pa.RecordBatch) -> np.ndarray:
        change = np.zeros(max(0, table.num_rows - 1), bool)
        for k in keys:
            change |= np.diff(table.column(k).to_numpy()) != 0
        return np.flatnonzero(change) + 1

    held: list[pa.RecordBatch] = []

    def complete() -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            cuts = [0, *edges(table).tolist(), table.num_rows]
            yield table, list(zip(cuts[:-1], cuts[1:], strict=True))

    def last(batch: pa.RecordBatch, row: int) -> tuple:
        return tuple(batch.column(k)[row].as_py() for k in keys)

    for batch in batches:
        if not batch.num_rows:
            continue
        inner = edges(batch)
        if len(inner):
            held.append(batch.slice(0, int(inner[-1])))
            yield from complete()
            held = [batch.slice(int(inner[-1]))]
        elif held and last(held[-1], -1) != last(batch, 0):
            yield from complete()
            held = [batch]
        else:
            held.append(batch)
    yield from complete()
    held.clear()
    give_back()
