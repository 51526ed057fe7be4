"""finlake: cloud usage and billing analytics on Spark.

Layers: ``sources`` (landing, lake and serving IO, test inputs), ``functions``
(column expressions and fixed values), ``operators`` (DataFrame -> DataFrame
transformations), ``streaming`` (the event ingestion job), ``plans`` (the
end-to-end pipeline, the query catalogue and its SQL oracle).
"""

__version__ = "0.1.0"
