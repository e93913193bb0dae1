"""lathe: tabular-regression data work on Spark DataFrames.

Validation, enrichment, cleaning, feature engineering, exact splits,
nearest-neighbour regression, evaluation, run tracking, batch and streaming
scoring — each an operator over DataFrames that Catalyst plans and Spark runs.
"""

__version__ = "0.1.0"
