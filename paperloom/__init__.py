"""Paperloom: document analytics expressed as Spark DataFrame plans.

Sub-packages: ``sources`` and ``sinks`` (files to tables and back), ``functions`` (column expressions),
``operators`` (DataFrame to DataFrame transforms), ``plans`` (named queries over the driver's tables),
``streaming`` (incremental versions) and ``llm`` (text-corpus operators; nothing else imports it).
"""

__version__ = "0.1.0"
