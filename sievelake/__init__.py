"""Batch data-quality checks on PySpark: classify, publish, register and reconcile monthly batches."""

from sievelake.batch import Batch, Lake
from sievelake.profiles import TRIPS, Profile, Rule

__all__ = ["Batch", "Lake", "Profile", "Rule", "TRIPS"]
