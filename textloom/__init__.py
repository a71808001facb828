"""textloom: text-corpus preparation for language-model training, as Spark jobs.

Every operator is ``DataFrame -> DataFrame`` or ``Column -> Column``; jobs in
``textloom.plans`` compose them.  Nothing is materialised on the driver except
small, size-bounded tables (budgets, histograms, merge lists).
"""

__version__ = "0.1.0"
