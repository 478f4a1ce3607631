from tickwise.functions.numeric import num, ieee_div
from tickwise.functions.ladder import (ladder, right_closed_bins, signal_rules,
                                       steps_above, steps_below)
from tickwise.functions.median import exact_median, approx_median, population_median
from tickwise.functions.sums import exact_avg, exact_sum

__all__ = ["num", "ieee_div", "ladder", "right_closed_bins", "signal_rules",
           "steps_above", "steps_below",
           "exact_median", "approx_median", "population_median", "exact_sum", "exact_avg"]
