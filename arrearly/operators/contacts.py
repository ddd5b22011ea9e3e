"""Customer contact-history operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearly.functions import columns as C
from arrearly.operators.windows import row_number_by_slice


def active_contacts(contacts: DataFrame) -> DataFrame:
    """Active alternative numbers per customer (all of them: the report keeps
    one row per active contact)."""
    return contacts.where(F.col("ACTIVE") == "Y").select("customer_id", "new_mobile_number", "change_date")


def contact_rank(contacts: DataFrame) -> DataFrame:
    """Active contacts numbered per customer from the oldest change date
    (rank 1 = oldest); ties broken by the number itself for determinism. A
    customer's contacts are numbered per change day, so a hot one spreads."""
    return row_number_by_slice(
        active_contacts(contacts), "customer_id", C.day("change_date"), ["change_date", "new_mobile_number"], out="rnk"
    ).select("customer_id", "new_mobile_number", "change_date", "rnk")
