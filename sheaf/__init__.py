"""sheaf: batch analytics jobs written as PySpark DataFrame / SQL plans.

Layout:
  sources/    readers (text, delimited, tab-typed), derived inputs, sinks
  functions/  column-expression helpers (money text, number checks, dates, nested access)
  operators/  the jobs: word counts, sector screener, fundamentals, join + growth,
              retail SQL set, nested table access, table lifecycle
  plans/      named queries over the driver tables, their DuckDB oracles, the registry
  streaming/  the word-count job run over a growing folder of text files
"""

__all__ = ["session"]
