"""txengine: card-transaction fraud analytics as Spark DataFrame jobs.

Layout:
  sources/    typed transaction schema, CSV / Parquet ingest, fixture adapters, dimensions
  functions/  column expressions shared by every plan (flags, money, guarded division)
  operators/  reusable DataFrame operators (running-so-far-today, trailing day windows,
              as-of anti join, size-checked broadcast join, classification counts)
  plans/      the jobs themselves: analysis, calendar grid, features, split, models,
              registry, assessment
  streaming/  the permanent deployment of a registered model as a Structured Streaming job
"""

__all__ = ["session"]
