"""Client value forecasting on Spark: ledger history, profile encoding, models, scores."""

from ledgercast.dimensions import Dimensions
from ledgercast.plans.cohort_plan import Cell, CohortPlan, CohortSettings, ScoringSettings

__all__ = ["Cell", "CohortPlan", "CohortSettings", "Dimensions", "ScoringSettings"]
