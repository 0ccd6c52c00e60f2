"""areacube: regional statistics cubes on Spark.

Turns person-level health and survey microdata into portal cubes
(period x geography x dimensions x measures, plus metadata tables) with
DataFrame operations only:

* ``operators``  - counting, gap filling, shares, trailing means, reshape,
  dictionaries, survey statistics, relabelling, derived indicators.
* ``functions``  - column-level helpers (text, codes, dates, F tail).
* ``sources``    - table readers (microdata, code lists, open statistics).
* ``sinks``      - cube bundle writer.
* ``plans``      - the four jobs composed from the operators, plus the
  query registry used by ``__spark_entry__``.
"""

__version__ = "0.1.0"
