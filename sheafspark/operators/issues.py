"""Issues over many outcomes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafspark.functions.outcomes import is_transient


def flat_issues(outcomes: DataFrame, issues: str = "issue") -> DataFrame:
    """One row per issue, next to the other columns."""
    keep = [c for c in outcomes.columns if c != issues]
    return outcomes.select(*keep, F.explode(issues).alias("_issue")).select(*keep, "_issue.*")


def issue_summary(outcomes: DataFrame, issues: str = "issue") -> DataFrame:
    """``(severity, code, count)`` over the issues of all outcomes."""
    rows = outcomes.select(F.explode(issues).alias("issue"))
    return rows.groupBy(F.col("issue.severity").alias("severity"), F.col("issue.code").alias("code")).agg(
        F.count("*").alias("count")
    )


def transient_issues(outcomes: DataFrame, issues: str = "issue") -> DataFrame:
    """The flat issues after which the same request may be sent again."""
    keep = [c for c in outcomes.columns if c != issues]
    rows = outcomes.select(*keep, F.explode(issues).alias("_issue"))
    return rows.where(is_transient(F.col("_issue"))).select(*keep, "_issue.*")
