"""Column types of the subscription tables.

Raw extracts carry a string key and 8-digit integer dates; see ``operators.transform`` and
``operators.keys`` for the typed forms.
"""

from __future__ import annotations

import re

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType


def _struct(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


_L, _S, _D = LongType(), StringType(), DoubleType()

RAW_SCHEMAS = {
    "train": _struct(msno=_S, is_churn=_L),
    "members": _struct(
        msno=_S, city=_L, bd=_L, gender=_S, registered_via=_L, registration_init_time=_L
    ),
    "transactions": _struct(
        msno=_S, payment_method_id=_L, payment_plan_days=_L, plan_list_price=_L, actual_amount_paid=_L,
        is_auto_renew=_L, transaction_date=_L, membership_expire_date=_L, is_cancel=_L,
    ),
    "user_logs": _struct(
        msno=_S, date=_L, num_25=_L, num_50=_L, num_75=_L, num_985=_L, num_100=_L, num_unq=_L, total_secs=_D
    ),
}

# Columns holding 8-digit integer dates in raw extracts (fixed names).
DATE_COLUMNS = ("date", "transaction_date", "membership_expire_date", "registration_init_time", "expiration_date")


def raw_schema(table_name: str) -> StructType | None:
    """Schema of a raw extract named like ``raw_user_logs_v2``; None if the name is not known."""
    return RAW_SCHEMAS.get(re.sub(r"^raw_|_v\d+$", "", table_name))
