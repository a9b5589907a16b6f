"""trajex: driving-scenario analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame.  Work is expressed
with built-in Spark expressions, joins and windows so Catalyst can prune,
push down and plan it; Python runs only in the yaw-return scan, per bounded
chunk (``operators.sequence``).

Main entry points:

* ``plans.scenario.scenario_labels`` - label every object row (L5)
* ``plans.lane_change.lane_change_pipeline`` - validated lane changes (L6)
* ``operators.sequence.yaw_return_scan`` - the yaw-return scan (W1/W3/W5)
* ``streaming.incremental.start_labelling`` - L5 over newly landed recordings
"""

from trajex.schema import ScanParams, Thresholds

__all__ = ["ScanParams", "Thresholds"]
