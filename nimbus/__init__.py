"""nimbus: hourly weather observations, the reports written from them and the
human ratings of those reports, as Spark DataFrame operators.

Every operator is a function DataFrame -> DataFrame or Column -> Column. No
operator runs an action, collects rows to the driver or keeps session state;
the few entry points that must run a job (streaming, sinks) say so.
"""

from nimbus.session import checkpoint_root, get_spark, scratch_path

__all__ = ["get_spark", "checkpoint_root", "scratch_path"]
