"""salesflow: retail transactions to trustworthy business metrics, on Spark DataFrames."""

from salesflow.rules import CleansingRules

__all__ = ["CleansingRules"]
