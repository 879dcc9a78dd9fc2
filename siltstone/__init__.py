"""Load operators for a layered warehouse (bronze, silver, gold) on Spark DataFrames."""

from siltstone.sources.warehouse import Warehouse

__all__ = ["Warehouse"]
