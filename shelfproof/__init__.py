"""shelfproof: master-data validation as Spark DataFrame jobs."""

from shelfproof.schema import Tables

__all__ = ["Tables"]
