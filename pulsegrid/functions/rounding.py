"""The three roundings of the pipeline.

* ``round_half_up``  - derived vitals, 2 places, halves away from zero.
* ``round_to_int``   - integer vitals, halves to even.
* ``round_to_tenth`` - body temperature, 1 place, decided on the exact binary value: 36.45 is stored
  slightly above 36.45 and goes to 36.5, while 36.25 is an exact half and goes to the even 36.2.
"""

from pyspark.sql import functions as F


def round_half_up(x, places=2):
    return F.round(x, places)


def round_to_int(x):
    """NULL where the whole number has no place in 32 bits."""
    return F.rint(x).try_cast("int")


def round_to_tenth(x):
    # 16x and 4x are exact, so total + lost is 20x without any rounding error.
    total = x * 16 + x * 4
    lost = x * 4 - (total - x * 16)
    twentieths = F.rint(total)
    # An odd count of twentieths lies near the middle of two tenths; what is left over decides.
    beyond = (total - twentieths) + lost
    return F.rint(twentieths / 2 + F.signum(beyond) * 0.25) / 10
