"""docweave — documentation-corpus analytics on Spark.

``sources``    page trees, page indexes, entity/hierarchy NDJSON, sinks
``operators``  the one Python stage (``shred``) and the Catalyst operators
``functions``  selector builders over the node array, text functions, fixed markup names
``plans``      test fixtures, the registered query catalog, the end-to-end pipeline
``streaming``  live progress and incremental extraction
"""

__version__ = "0.1.0"
