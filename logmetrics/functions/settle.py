"""Working an expression out once."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settle(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Like ``withColumns``, for expressions that must not be worked out again.

    A filter on a projected column moves below the projection and below an
    aggregation, where the expression runs on every row a second time, or on every
    line instead of once per file. Columns that come out of a one-row ``inline``
    stay where they are. They are not pruned singly, so put in what is used.
    """
    fields = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*[c for c in df.columns if c not in columns], F.inline(F.array(fields)))


def worked_out(df: DataFrame, *columns: str) -> bool:
    """Is any of the columns an expression, rather than read from a table as it is?"""
    plan = df._jdf.queryExecution().analyzed()
    leaves = plan.collectLeaves()
    read = {a.exprId().id() for i in range(leaves.size()) for a in _each(leaves.apply(i).output())}
    own = {a.name(): a.exprId().id() for a in _each(plan.output())}
    return any(own[c] not in read for c in columns)


def _each(seq):
    return [seq.apply(i) for i in range(seq.size())]
