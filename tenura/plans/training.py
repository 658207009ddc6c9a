"""The training table out of preprocessed tables, with its checks and export."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tenura.operators import reports
from tenura.operators.features import feature_table
from tenura.session import materialize
from tenura.sources.files import write_parquet_tables


def training_table(
    tables: Mapping[str, DataFrame], weekday_mode: str = "documented", fill: float | None = 0.0
) -> DataFrame:
    """``ml_features`` from ``members_merge``, ``transactions_seq`` and ``user_logs_merge``."""
    return feature_table(
        tables["members_merge"], tables["transactions_seq"], tables["user_logs_merge"], weekday_mode, fill
    )


def training_run(
    tables: Mapping[str, DataFrame],
    output_dir: str | None = None,
    weekday_mode: str = "documented",
    fill: float | None = 0.0,
) -> dict[str, DataFrame]:
    """Build the training table once, check it, and write it as Parquet if a folder is given."""
    features = materialize(training_table(tables, weekday_mode, fill), "ml-features")
    result = {"ml_features": features}
    result.update({f"validation_{k}": v for k, v in reports.validate_features(features).items()})
    result.update({f"nulls_{k}": v for k, v in reports.null_report(features).items()})
    if output_dir:
        write_parquet_tables({"ml_features": features}, output_dir)
    return result
