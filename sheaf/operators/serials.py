"""Split of serial records into one record per issue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the MARC field that holds one issue.
ISSUE_TAG = "974"


def tagged(fields: Column, tags: list[str], include: bool = True) -> Column:
    """Fields of a MARC record (one-key maps) whose tag is, or is not, in ``tags``."""
    def listed(f: Column) -> Column:
        return F.coalesce(F.get(F.map_keys(f), F.lit(0)).isin(tags), F.lit(False))

    return F.filter(fields, lambda f: listed(f) if include else ~listed(f))


def split_serials(df: DataFrame, fields: str = "fields", tag: str = ISSUE_TAG) -> DataFrame:
    """One row per issue field, with the shared fields before it; no issue, no row."""
    others = [c for c in df.columns if c != fields]
    shared = df.select(*others, tagged(F.col(fields), [tag], include=False).alias("_shared"),
                       F.posexplode(tagged(F.col(fields), [tag])).alias("issue_no", "_issue"))
    return shared.select(*others, "issue_no", F.concat("_shared", F.array("_issue")).alias(fields))
