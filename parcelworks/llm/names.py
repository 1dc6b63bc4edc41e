"""Names for helper columns that no column of a user's table has."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import wraps

from pyspark.sql import DataFrame


def unused(columns: Iterable[str], *wanted: str) -> list[str]:
    """The wanted names, each lengthened until no column (in any case) has it."""
    taken = {c.lower() for c in columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def sets_aside(*own: str) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """For an operator with helper columns ``own``: a table's columns of these names pass under others.

    The operator takes the table first. Arguments that name such a column follow it, and the
    result has the table's names again.
    """
    reserved = {name.lower() for name in own}

    def wrap(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @wraps(operator)
        def run(docs: DataFrame, *args: object, **options: object) -> DataFrame:
            clash = [c for c in docs.columns if c.lower() in reserved]
            if not clash:
                return operator(docs, *args, **options)
            away = dict(zip(clash, unused([*docs.columns, *own], *clash), strict=True))
            named = lambda x: away.get(x, x) if isinstance(x, str) else x
            done = operator(
                docs.withColumnsRenamed(away), *map(named, args), **{k: named(v) for k, v in options.items()}
            )
            return done.withColumnsRenamed({new: old for old, new in away.items()})

        return run

    return wrap
