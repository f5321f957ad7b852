"""Record schemas, one per kind of input."""

from __future__ import annotations

from collections import Counter

from pyspark.sql.types import (
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def strings(names: str | list[str]) -> StructType:
    """All-string, nullable schema from a space-separated text or list of names."""
    parts = names.split() if isinstance(names, str) else list(names)
    repeated = sorted(n for n, c in Counter(p.lower() for p in parts).items() if c > 1)
    if repeated:
        raise ValueError(f"column names repeat: {', '.join(repeated)}")
    return StructType([StructField(p, StringType(), True) for p in parts])


LINE = strings("value")

PEOPLE_CSV = StructType(
    [
        StructField("name", StringType(), True),
        StructField("age", IntegerType(), True),
        StructField("job", StringType(), True),
    ]
)

ORDER = StructType(
    [
        StructField("ip", StringType(), True),
        StructField("money", DecimalType(10, 2), True),
        StructField("status", StringType(), True),
    ]
)

IP_RANGE = StructType(
    [
        StructField("ip_start", LongType(), True),
        StructField("ip_end", LongType(), True),
        StructField("region", StringType(), True),
        StructField("province", IntegerType(), True),
        StructField("city", IntegerType(), True),
    ]
)

KEY_VALUE = strings("key value")
