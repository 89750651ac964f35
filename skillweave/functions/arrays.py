"""Array helpers that stay inside one row, so none of them shuffles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    Without it an expression used inside a lambda is evaluated again for every element.
    """
    return F.transform(F.array(value), body)[0]


def term_counts(terms: Column) -> Column:
    """``array<string>`` to ``array<struct<term, tf>>``, one entry per distinct term.

    Sorts within the row and measures the runs, so the (row, term) pairs exist without a shuffle.
    """

    def runs(ordered: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(1), F.size(ordered)),
            lambda i: (i == 1) | (F.get(ordered, i - 1) != F.get(ordered, i - 2)),
        )
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda start, j: F.struct(
                    F.get(ordered, start - 1).alias("term"),
                    (F.coalesce(F.get(at, j + 1), F.size(ordered) + 1) - start).cast("bigint").alias("tf"),
                ),
            ),
        )

    empty = F.array().cast("array<struct<term:string,tf:bigint>>")
    return F.when(F.size(terms) > 0, let(F.sort_array(terms), runs)).otherwise(empty)


def string_array(values: list[str]) -> Column:
    """A literal ``array<string>``, also for an empty list."""
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")
