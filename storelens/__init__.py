"""storelens: commerce and rental analytics as Spark DataFrame operators.

Layout
------
- ``sources``    tables (TPC-H-named folders, store-shaped folders, catalog
                 schemas) and the adapter views between them
- ``functions``  column-level helpers (calendar vs whole days, exact
                 half-up rounding of ratios and means)
- ``operators``  reusable DataFrame -> DataFrame building blocks
                 (summaries, sequences, segments)
- ``plans``      the statement-level analyses composed from the operators,
                 plus the registry used by ``__spark_entry__``
- ``llm``        operators for training-data corpora (nothing here imports it)
"""

__version__ = "0.1.0"
