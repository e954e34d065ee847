"""sylva: DataFrame operators for mining corpora of tree-structured documents on Spark.

Tables: ``submissions`` (metadata), ``sources`` (text), ``nodes`` (tree nodes as
rows, parent pointers). Operators are ``DataFrame -> DataFrame`` functions built
from Spark SQL built-ins; see the sub-packages:

* ``sylva.sources``   - readers, fixture builders, the HTML parse job
* ``sylva.operators`` - metadata, sampling, tree, path-context, diff, label operators
* ``sylva.functions`` - column expressions (path encoders, masks, line splitting)
* ``sylva.plans``     - the three composite jobs and the named-policy registries
* ``sylva.sinks``     - Parquet and text exports
* ``sylva.streaming`` - click-toggle state on a stream
"""

__version__ = "0.1.0"
