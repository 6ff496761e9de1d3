"""Keeping computed columns computed."""

from pyspark.sql import DataFrame, functions as F


def computed_once(df: DataFrame, *computed: str) -> DataFrame:
    """The same rows, with the `computed` columns as the output of a generator.

    The planner moves filters (also those it infers itself, as for an explode)
    and semi-joins below projections by writing the computed column's
    expression out wherever it is used. Over a chain of projections the
    expression grows exponentially, and so does planning time; it would also
    run again for every comparison. A generator's output is not written out, so
    what is above stays above. The other columns remain open to pruning and
    pushed filters.
    """
    others = [name for name in df.columns if name not in computed]
    return df.select(*others, F.inline(F.array(F.struct(*computed))))
