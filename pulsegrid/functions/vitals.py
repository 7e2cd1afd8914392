"""Derived vitals. Inputs are doubles; missing inputs and a zero height give NULL."""

from pyspark.sql import functions as F

from .casting import as_double
from .rounding import round_half_up


def pulse_pressure(systolic, diastolic):
    return round_half_up(systolic - diastolic)


def body_mass_index(weight_kg, height_m):
    return round_half_up(F.try_divide(weight_kg, F.pow(height_m, F.lit(2.0))))


def mean_arterial_pressure(systolic, diastolic):
    return round_half_up(diastolic + (systolic - diastolic) / 3)


def metres(height_cm):
    return as_double(height_cm) / 100
