"""medalla: layered complaint analytics on Spark.

Raw complaint rows are profiled, conformed into a typed clean layer (with the
rejected rows kept and explained), aggregated into entity, product, monthly,
ranking and KPI marts, summarised, segmented with MLlib and forecast.

Every operator is DataFrame in, DataFrame out, with column names as
parameters. Nothing in an operator collects data to the driver.
"""

from medalla.session import get_spark, ensure_checkpoint_dir

__all__ = ["get_spark", "ensure_checkpoint_dir"]
