"""Lifecycle analytics over per-entity event panels, on Spark DataFrames.

Mortgage servicing is the main case: from an origination table and a monthly
servicing panel, derive lag features and delinquency state, first-time
delinquency / default / modification events, the terminal record, loss and
disposition facts, and one wide row per loan.

Every function takes DataFrames and returns DataFrames; nothing here creates a
SparkSession at import time and nothing collects data to the driver.
"""

from loanlife.operators.detail import servicing_detail
from loanlife.operators.events import loan_events
from loanlife.operators.master import loan_master

__all__ = ["servicing_detail", "loan_events", "loan_master"]
