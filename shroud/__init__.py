"""shroud: statistical de-identification of person-level tables on Spark.

Every operator is a function ``DataFrame -> DataFrame`` (or a small result
DataFrame for measurements) built from Spark SQL expressions, aggregations and
joins.  See README.md for the operator inventory.
"""

from shroud.functions.columns import EXACT  # noqa: F401
from shroud.plans.release import (  # noqa: F401
    ReleaseConfig, anonymize, generalize_stage, release_report, release_stage,
)
from shroud.sources.io import export_csv, export_view, load_source  # noqa: F401

__version__ = "0.1.0"
