"""Matrix functions over array columns, evaluated per Arrow batch inside the tasks.

The functions built here carry everything they need in their closure, so the workers do not
import this package.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


MERGERS = 8  # tasks that add up the partial sums of all others
DIRECT = 1_000_000  # numbers that may reach the driver without them


def summed(data: DataFrame, add: Callable, length: int, parts: int | None = None) -> np.ndarray:
    """Sum of an array of ``length`` numbers that ``add(total, batch)`` fills per partition.

    The partial sums go to ``MERGERS`` tasks, which add them up as they arrive; as many arrays reach the driver. Where
    the number of partitions is given and all their sums are at most ``DIRECT`` numbers, they come to the driver at once.
    """

    def total_of(batches, take):
        import numpy
        import pyarrow

        total = numpy.zeros(length)
        for batch in batches:
            if batch.num_rows:
                take(total, batch)
        yield pyarrow.RecordBatch.from_arrays([pyarrow.array([total.tobytes()], "binary")], ["v"])

    def merge(total, batch):
        import numpy

        for v in batch.column(0).to_pylist():
            total += numpy.frombuffer(v)

    partial = data.mapInArrow(lambda batches: total_of(batches, add), "v binary")
    if parts is not None and parts * length <= DIRECT:
        merged = partial
    else:
        merged = partial.repartition(MERGERS).mapInArrow(lambda batches: total_of(batches, merge), "v binary")
    return np.sum([np.frombuffer(r["v"]) for r in merged.collect()], axis=0) + np.zeros(length)


def per_batch(function: Callable[[np.ndarray], np.ndarray], values: Column) -> Column:
    """Apply an (n, p) -> (n, q) numpy function to an ``array<double>`` column without nulls."""

    def apply(batch):
        import numpy
        import pyarrow

        if len(batch) == 0:
            return pyarrow.array([], pyarrow.list_(pyarrow.float64()))
        matrix = batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
        result = numpy.ascontiguousarray(function(matrix), dtype="float64")
        offsets = numpy.arange(0, result.size + 1, result.shape[1], dtype="int32")
        return pyarrow.ListArray.from_arrays(offsets, result.ravel())

    return F.arrow_udf(apply, "array<double>")(values)


def vector_map(function: Callable[[np.ndarray], np.ndarray], features: str) -> Column:
    """The same for a vector column, giving a vector column."""
    return array_to_vector(per_batch(function, vector_to_array(features)))


def counted(df: DataFrame, features: str, label: str, roles: Column) -> DataFrame:
    """Different rows with their number ``w``: ``x, y, r``, for fits to which equal rows are one row that counts more."""
    chosen = df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), roles.cast("array<tinyint>").alias("r"))
    return chosen.groupBy("x", "y", "r").agg(F.count("*").cast("double").alias("w"))


def packed_counted(rows: DataFrame, size: int = 4096) -> DataFrame:
    """The rows of ``counted`` as blocks of matrices, as ``packed`` makes them, with ``w`` as packed doubles."""

    def pack(batches):
        import numpy
        import pyarrow

        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                x, r = (part.column(c).flatten().to_numpy(zero_copy_only=False).astype(t) for c, t in ((0, "float64"), (2, "int8")))
                y, w = (part.column(c).to_numpy(zero_copy_only=False).astype("float64") for c in (1, 3))
                columns = [pyarrow.array([part.num_rows], "int32"), *(pyarrow.array([numpy.ascontiguousarray(v).tobytes()], "binary") for v in (x, y, r, w))]
                yield pyarrow.RecordBatch.from_arrays(columns, ["n", "x", "y", "r", "w"])

    return rows.select("x", "y", "r", "w").mapInArrow(pack, "n int, x binary, y binary, r binary, w binary")


def packed(df: DataFrame, features: str, label: str, roles: Column, rows: int = 4096) -> DataFrame:
    """Rows as blocks of matrices for fits that scan them many times: ``n, x, y, r`` (packed doubles; bytes for roles).

    ``roles`` is an array of small whole numbers, as long for every row: what a row is to each of several fits. Rows
    without a label have a label of NaN.
    """

    def pack(batches):
        import numpy
        import pyarrow

        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                x = part.column(0).flatten().to_numpy(zero_copy_only=False).astype("float64")
                y = part.column(1).to_numpy(zero_copy_only=False).astype("float64")
                r = part.column(2).flatten().to_numpy(zero_copy_only=False).astype("int8")
                columns = [pyarrow.array([part.num_rows], "int32"), *(pyarrow.array([numpy.ascontiguousarray(v).tobytes()], "binary") for v in (x, y, r))]
                yield pyarrow.RecordBatch.from_arrays(columns, ["n", "x", "y", "r"])

    chosen = df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), roles.cast("array<tinyint>").alias("r"))
    return chosen.mapInArrow(pack, "n int, x binary, y binary, r binary")


def over_blocks(add: Callable) -> Callable:
    """``add(total, x, y, r)`` on the matrices of packed blocks, for ``summed``; also ``w`` where the blocks have it."""

    def run(total, batch):
        import numpy

        for at in range(batch.num_rows):
            n, *values = (column[at].as_py() for column in batch.columns)
            x, y, r, *w = (numpy.frombuffer(v, t) for v, t in zip(values, ("float64", "float64", "int8", "float64")))
            add(total, x.reshape(n, -1), y, r.reshape(n, -1), *w)

    return run
