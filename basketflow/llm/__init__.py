"""Training-data operators: ten operators over document, page and embedding tables.

Nothing else in the library imports this package.  Conventions shared by all
operators:

* an operator takes a DataFrame and column names, keeps the input's other
  columns, and its output columns *replace* input columns of the same name;
* a null text (html, url) counts as empty unless the operator says otherwise;
* intermediate tables go below ``spark.checkpoint.dir`` (``common.stage``).
"""
