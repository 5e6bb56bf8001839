"""Customer credit-risk features, labels, models and scoring on Spark DataFrames."""

from riskloom.columns import TxnColumns

__all__ = ["TxnColumns"]
__version__ = "0.1.0"
