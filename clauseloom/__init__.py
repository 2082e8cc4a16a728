"""clauseloom: compliance rules over loan files, and the audit of those rules, as Spark jobs.

Every operator is a function from DataFrames to a DataFrame. Nothing runs until the caller asks
for a result, except the iterative `blocked_rules`, which must look at each round's frontier.
"""

from clauseloom.model import DaySet, Derived, Pack, Rule, Vocabulary, timing_pack

__all__ = ["DaySet", "Derived", "Pack", "Rule", "Vocabulary", "timing_pack"]
