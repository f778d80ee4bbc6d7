"""tableload: load, merge and reconcile lakehouse tables with Spark DataFrames."""

from tableload.contract import TableContract, validate
from tableload.errors import ContractError
from tableload.plans.load import Receipt, load
from tableload.plans.verify_load import problems, verify_load
from tableload.sources.dataset import Dataset
from tableload.streaming.stream_merge import stream_merge

__all__ = ["ContractError", "Dataset", "Receipt", "TableContract", "load", "problems", "stream_merge",
           "validate", "verify_load"]
