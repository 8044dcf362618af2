"""quire: document text to Markdown, chapters and section summaries on Spark.

Subpackages: ``functions`` (column functions), ``sources`` (tables, files,
derived corpora), ``operators`` (assembly, Markdown, chapters, reflow, language
identification, summaries), ``plans`` (composed flows, registered queries and
their SQL oracles), ``sinks`` and ``streaming``.
"""

__version__ = "0.1.0"
