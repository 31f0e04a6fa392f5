"""IPv4 text to number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IPV4_SHAPE = r"^\d{1,3}(\.\d{1,3}){3}\z"


def ip_to_long(ip: Column) -> Column:
    """Four octets folded left by 8 bits and OR; a bad shape gives 0, null stays null.

    Octets above 255 are not rejected: their high bits run into the octet before.
    """
    shaped = F.when(ip.isNull() | ip.rlike(IPV4_SHAPE), ip).otherwise(F.lit("0.0.0.0"))
    return F.aggregate(
        F.split(shaped, "[.]"),
        F.lit(0).cast("bigint"),
        lambda number, octet: F.shiftleft(number, 8).bitwiseOR(octet.cast("bigint")),
    )
