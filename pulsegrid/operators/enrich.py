"""Decoded text rows to numbers with derived vitals."""

from pyspark.sql import functions as F

from ..functions import as_double, as_float, body_mass_index, finite, mean_arterial_pressure, pulse_pressure
from ..schemas import FLOAT_COLUMNS


def derive(rows):
    """Pulse pressure, body-mass index and mean arterial pressure, computed in double from text."""
    systolic = as_double("Systolic Blood Pressure")
    diastolic = as_double("Diastolic Blood Pressure")
    return rows.withColumns({
        "Derived_Pulse_Pressure": pulse_pressure(systolic, diastolic),
        "Derived_BMI": body_mass_index(as_double("Weight"), as_double("Height")),
        "Derived_MAP": mean_arterial_pressure(systolic, diastolic),
    })


def cast_floats(rows, columns=FLOAT_COLUMNS):
    """All numeric columns to FLOAT in one projection; unreadable text, and text for no finite number, becomes NULL."""
    return rows.withColumns({c: finite(as_float(F.col(c))) for c in columns})


def enrich(rows):
    """Derived first, in double, then cast: the order decides the last digits."""
    return cast_floats(derive(rows))
