"""hiremart: job-posting analytics as Spark DataFrame transformations.

Layers:
  functions/  Column -> Column expressions (text cleaning, buckets, rule tables)
  sources/    readers and writers (JSON lines, TSV, ragged TSV, CSV/Parquet export)
  operators/  reusable distributed operators (dense numbering, distinct-first
              classification, rollup totals, top-N, shares, pivots, sized broadcast)
  plans/      the marts of the job wired together, plus the batch entry point
  streaming/  (the reference has no streaming; see the package docstring)
"""
