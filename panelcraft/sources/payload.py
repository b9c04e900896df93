"""Semi-structured payloads -> long rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcraft.functions.expressions import sentinel_clamp


def flatten_json_map(df: DataFrame, json_col: str, keep: Sequence[str],
                     path: Sequence[str] = (), value_type: str = "double",
                     key_name: str = "key", value_name: str = "value") -> DataFrame:
    """Parse ``json_col``, walk ``path`` (nested object keys) to a ``{key: value}``
    object and emit one row per entry.

    For the reference's payload ``{"properties":{"parameter":{"X":{"20100101":1.5}}}}``
    use ``path=("properties", "parameter", "X")``.  Malformed JSON gives no rows.
    """
    schema = f"map<string,{value_type}>"
    for name in reversed(path):
        schema = f"struct<`{name}`:{schema}>"
    parsed = F.from_json(F.col(json_col), schema)
    for name in path:
        parsed = parsed.getField(name)
    return df.select(*keep, F.explode(parsed).alias(key_name, value_name))


def daily_series_rows(df: DataFrame, json_col: str, keep: Sequence[str], path: Sequence[str],
                      sentinel: float = -999.0, digits: int = 3) -> DataFrame:
    """Payload -> (keep..., date, year, month, day, value) with sentinel/clamp cleaning.

    ``date`` stays the ``yyyyMMdd`` text of the payload; parts are cut from it.
    """
    rows = flatten_json_map(df, json_col, keep, path, "double", "date", "raw")
    return rows.select(*keep, "date",
                       F.substring("date", 1, 4).cast("int").alias("year"),
                       F.substring("date", 5, 2).cast("int").alias("month"),
                       F.substring("date", 7, 2).cast("int").alias("day"),
                       sentinel_clamp("raw", sentinel, 0.0, 0.0, digits).alias("value"))
