"""Column means per case, and filling gaps with them."""

from pyspark.sql import functions as F


def exact_mean(c):
    """Mean over decimals with nine places: equal for any order and partitioning of the rows.

    Values that no such decimal can hold, not finite or from 10^19 up, are neither summed nor counted.
    """
    exact = summable(c)
    return F.try_divide(F.sum(exact).cast("double"), F.count(exact))


def summable(c):
    return c.cast("double").try_cast("decimal(28,9)")


def mean_name(column):
    return f"mean {column}"


def case_means(samples, columns, keys=("caseid", "stay")):
    """(caseid, stay, "mean <column>"...): empty values are skipped; an all-empty column has no mean."""
    return samples.groupBy(*keys).agg(*[exact_mean(F.col(c)).alias(mean_name(c)) for c in columns])


def fill_with_means(samples, columns):
    """Empty values get the case's mean, which ``attach_case_values`` has put beside them."""
    filled = {c: F.coalesce(F.col(c), F.col(mean_name(c))) for c in columns}
    return samples.withColumns(filled).drop(*[mean_name(c) for c in columns])
