"""Column roles of a transaction table."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TxnColumns:
    """Names of the columns the feature operators read."""

    id: str = "CustomerId"
    amount: str = "Amount"
    value: str = "Value"
    time: str = "TransactionStartTime"
    label: str = "FraudResult"


DEFAULT = TxnColumns()
