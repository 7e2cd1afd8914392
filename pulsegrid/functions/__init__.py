"""Column functions; all are built from Spark's own expressions."""

from .casting import as_double, as_float, as_int, blank_nan, finite
from .risk import risk_label, risk_label_by_position
from .rounding import round_half_up, round_to_int, round_to_tenth
from .timegrid import event_time, iso_millis, slot_of, slot_start
from .vitals import body_mass_index, mean_arterial_pressure, metres, pulse_pressure

__all__ = [
    "as_double", "as_float", "as_int", "blank_nan", "body_mass_index", "event_time", "finite", "iso_millis",
    "mean_arterial_pressure", "metres", "pulse_pressure", "risk_label", "risk_label_by_position",
    "round_half_up", "round_to_int", "round_to_tenth", "slot_of", "slot_start",
]
