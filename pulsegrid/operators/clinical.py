"""The clinical table: choice of cases and columns, one row per case, cases without a row."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import CLINICAL_COLUMNS


NO_ROW = "no clinical row"


def case_key(c):
    """Case ids are compared as numbers: "007" is case 7; an id that is no number stays as it is."""
    number = c.try_cast("bigint")
    return F.coalesce(number.cast("string"), c.cast("string"))


def only_cases(rows, case_ids=None):
    """Rows of the cases asked for: a list of ids, or a table of any size with a ``caseid`` column; all rows without either."""
    if case_ids is None or (not isinstance(case_ids, DataFrame) and not case_ids):
        return rows
    key = case_key(F.col("caseid"))
    if isinstance(case_ids, DataFrame):
        wanted = case_ids.select(case_key(F.col("caseid")).alias("wanted_case")).distinct()
        return rows.join(wanted, key == F.col("wanted_case"), "left_semi")
    return rows.where(key.isin([str(int(i)) for i in case_ids]))


def select_cases(clinical, case_ids=None):
    """The five kept columns, for all cases or those asked for; see ``only_cases``.

    Case ids are compared as numbers: "01" is case 1, and a row whose id is no number belongs to no case.
    """
    number = F.col("caseid").try_cast("bigint")
    return (only_cases(clinical, case_ids).where(number.isNotNull()).select(*CLINICAL_COLUMNS)
            .withColumn("caseid", number.cast("string")))


def first_per_case(clinical, order=("age", "sex", "height", "weight")):
    """One row per case, the first in ``order``; each task keeps one row per case before the shuffle."""
    in_order = Window.partitionBy("caseid").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return (clinical.withColumn("rank", F.row_number().over(in_order))
            .where(F.col("rank") == 1).drop("rank"))


def unknown_cases(readings, clinical):
    """Cases with readings but without a clinical row: rejected with a reason, not lost."""
    cases = readings.groupBy("caseid").agg(F.count("*").alias("n_readings"))
    return (cases.join(clinical.select("caseid").distinct(), "caseid", "left_anti")
            .withColumn("reason", F.lit(NO_ROW)))
