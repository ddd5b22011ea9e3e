"""arrearly: delinquent-loan segmentation and case reporting on Spark."""

from arrearly.params import Params  # noqa: F401
from arrearly.sources.tables import LoanTables  # noqa: F401

__version__ = "0.1.0"
