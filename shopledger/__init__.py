"""Store-chain analytics expressed as plain Spark DataFrame programs.

Layers, bottom up:

* ``functions`` - column expressions (guarded ratios, lenient parsing, text).
* ``sources``   - landing files, exchange-rate XML, versioned warehouse tables.
* ``operators`` - reusable DataFrame-to-DataFrame steps (cleaning, merge, ...).
* ``plans``     - marts, reports, narratives, dashboards and the ingest flow.
* ``streaming`` - incremental ingest of newly landed files.
"""

__version__ = "0.1.0"
