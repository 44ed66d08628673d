"""Arrow UDFs that make Python objects of a small part of a batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

#: Bytes of Arrow data whose Python objects exist at once in a worker; a longer row goes whole.
PIECE_BYTES = 1 << 20


def pieces(values: pa.Array, most: int = PIECE_BYTES) -> Iterator[pa.Array]:
    """Slices of at most so many bytes or one row, in order; an empty array is one."""
    if values.nbytes <= most or len(values) < 2:
        yield values
        return
    half = len(values) // 2
    yield from pieces(values.slice(0, half), most)
    yield from pieces(values.slice(half), most)


def by_pieces(kind: DataType) -> Callable:
    """An Arrow UDF of one column. Spark's batches have up to 10,000 rows or 64 MB, several times that as Python objects: each piece is worked on and handed on alone."""

    def wrap(work: Callable[[pa.Array], pa.Array]):
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                for piece in pieces(batch):
                    yield work(piece)

        run.__name__, run.__doc__ = work.__name__, work.__doc__  # not functools.wraps: Spark reads the type hints of run
        return F.arrow_udf(kind)(run)

    return wrap
