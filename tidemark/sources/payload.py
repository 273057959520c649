"""JSON payloads held in files or in a string column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.project import watermark_filter


def payload_rows(
    df: DataFrame,
    column: str,
    schema: str,
    keep: list[str] | None = None,
    entries: str | None = None,
    change_column: str = "lastLoadDate",
    since: Column | None = None,
) -> DataFrame:
    """Parse a JSON column into rows.

    ``entries`` names an enclosed array to unfold.  The watermark applies only
    when the parsed rows have the change column.
    """
    kept = keep if keep is not None else [c for c in df.columns if c != column]
    parsed = df.select(*kept, F.from_json(column, schema).alias("_p"))
    if entries is not None:
        parsed = parsed.select(*kept, F.explode(f"_p.{entries}").alias("_p"))
    rows = parsed.select(*kept, "_p.*")
    return rows if since is None else watermark_filter(rows, change_column, since, only_if_present=True)
