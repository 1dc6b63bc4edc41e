"""Value and reason pairs.

A number or date that may be replaced by an explanation is held as two columns:
``x`` (typed, nullable) and ``x_reason`` (text, null while a value exists).
``render_sentinels`` folds the pair into text for an export.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The explanations written in place of a value.
NO_COST = "no_cost_avl"
NO_TAX = "no_tax_avl"
NO_SHIPPING = "no_shipping_avl"
NO_MAPPING = "no_mapping_avl"
NO_BATCH = "no_batch_created"
DATE_MISSING = "date_missing"
NOT_APPLICABLE = "NA"

SUFFIX = "_reason"


def pair(name: str, value: Column, reason: Column) -> dict[str, Column]:
    """Both columns of a pair, ready for ``withColumns``; the reason blanks the value."""
    return {
        name: F.when(reason.isNull(), value),
        name + SUFFIX: reason,
    }


def render_sentinels(df: DataFrame) -> DataFrame:
    names = set(df.columns)
    out = []
    for c in df.columns:
        if c.endswith(SUFFIX) and c[: -len(SUFFIX)] in names:
            continue
        if c + SUFFIX in names:
            out.append(F.coalesce(F.col(c + SUFFIX), F.col(c).cast("string")).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)
