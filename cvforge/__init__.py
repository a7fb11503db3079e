"""cvforge: feature preparation, fold-local feature selection and model evaluation as Spark jobs.

Every operator takes and returns a ``pyspark.sql.DataFrame``; nothing is collected
to the driver except bounded metadata (class labels, split tables, validation
errors). See README.md for the operator map.
"""

from cvforge.spec import BoostParams, FeatureSpec, GridSpec, RunConfig

__all__ = ["BoostParams", "FeatureSpec", "GridSpec", "RunConfig"]
