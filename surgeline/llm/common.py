"""Helpers shared by the operators of this subpackage."""

import pyarrow as pa

from pyspark.sql import functions as F


def with_column(batch, name, array):
    """The Arrow batch with ``array`` under ``name``, replacing a column of that name."""
    names, columns = list(batch.schema.names), list(batch.columns)
    if name in names:
        columns[names.index(name)] = array
    else:
        names.append(name)
        columns.append(array)
    return pa.RecordBatch.from_arrays(columns, names=names)


def free_name(df, wanted):
    """``wanted``, or ``wanted`` with underscores in front if ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def held_out(id_col, folds, fold):
    """True for rows whose crc32(id as text) leaves ``fold`` when divided by ``folds``."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def texts_of(batch, column):
    """The column as Python strings, null as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def sliced(batches, rows):
    """The same Arrow batches in slices of at most ``rows`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
