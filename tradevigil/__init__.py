"""Trade surveillance on Spark: feeds, features, client networks, alerts, reports.

Every function takes DataFrames and returns a DataFrame; only `sources.tables`,
`sources.feeds`, `streaming` and `plans.stages` touch the catalog.
"""

__version__ = "0.1.0"
