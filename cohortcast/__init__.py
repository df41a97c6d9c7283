"""cohortcast: cohort revenue-per-paid-day forecasting as Spark DataFrame plans."""

from cohortcast.params import FIXTURE, PRODUCTION, Params

__all__ = ["Params", "PRODUCTION", "FIXTURE"]
