"""Column choice, naming and order."""

from pyspark.sql import types as T

from ..schemas import CLINICAL_RENAMES, KEY_COLUMNS, TRACK_COLUMNS


def rename_columns(df):
    """Clinical and track columns get their readable names."""
    return df.withColumnsRenamed({**CLINICAL_RENAMES, **TRACK_COLUMNS})


def keys_first(df, keys=KEY_COLUMNS):
    """Key columns first, the others behind them in the order they have."""
    return df.select(*keys, *[c for c in df.columns if c not in keys])


def numeric_columns(df, leave_out=()):
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in leave_out]


def fractional_columns(df, leave_out=()):
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.FloatType, T.DoubleType)) and f.name not in leave_out]
