"""sitelens: DataFrame operators for turning published tables into a checked,
joined and reportable data product, written as ordinary Spark plans.

Map of the package:

* ``sitelens.functions`` - Column expressions (lenient numbers, key
  normalisation, guarded ratios, formats, text measures, snippets, URL and
  category codecs).
* ``sitelens.operators`` - DataFrame operators: ``clean``, ``join``,
  ``grain``, ``stats``, ``report``, ``quality``, ``catalogue``, ``search``.
* ``sitelens.sources`` - readers and writers (parquet / CSV / JSON with
  explicit schemas and contracts, workbooks, header-block documents).
* ``sitelens.plans`` - composite jobs, the full-refresh batch job and the
  registered queries with their SQL oracle.
* ``sitelens.session`` - session settings, data-sized configuration, the
  shared checkpoint folder and published stage outputs.
"""

__version__ = "0.1.0"
