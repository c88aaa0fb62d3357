"""cohortlens: tabular risk analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function (fits return a small
fitted object with ``.transform``). Work stays inside Spark SQL / MLlib; only
bounded fit results (medians, modes, levels, class counts) reach the driver.
"""

from cohortlens.spec import Spec, clinical_spec, orders_binding_spec

__all__ = ["Spec", "clinical_spec", "orders_binding_spec"]
