"""tessera: a Spark-native engine for company-registry panel analytics.

Every public operator is a ``DataFrame -> DataFrame`` function (chain them
with ``DataFrame.transform``).  Heavy work stays on executors; the driver
only ever sees small aggregates.

Sub-packages:

* ``sources``   - landed files (CSV, JSON series, ZIP archives) and the driver tables
* ``sinks``     - table writes, partition overwrite, load status roll-ups
* ``functions`` - scalar column expressions (dates, text, paths, messages, scores)
* ``operators`` - cleaning, profiling, features, transitions, datasets, evaluation, models
* ``plans``     - the derived panel and the registered queries with their SQL oracles
* ``streaming`` - incremental file ingestion and message-triggered loads
"""

__version__ = "0.1.0"
