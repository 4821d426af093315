"""recordforge: record cleaning, linking and wage analytics as Spark DataFrame plans.

Sub-packages:

* ``functions``  - column-expression builders (name normalisation, safe casts, digit tests ...)
* ``operators``  - DataFrame -> DataFrame operators (repairs, dedup, links, merges, TSV split)
* ``sources``    - readers, sinks and the adapters that derive staging-shaped inputs from tables
* ``plans``      - analytics views and end-to-end table builds, plus the query catalog
* ``streaming``  - the TSV split run incrementally over a landing folder
"""

__all__ = ["functions", "operators", "sources", "plans", "streaming"]
