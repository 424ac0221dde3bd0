"""modelyard: model trials on Spark DataFrames.

Load, filter, split, fit candidate models, score every row with every model,
measure, rank and record runs -- all as DataFrame plans.
"""

__version__ = "0.1.0"
