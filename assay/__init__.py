"""assay: a Spark-native engine for end-of-line test data.

Layers:
    sources/    delimited readers with lineage, layer writers, table sinks
    functions/  column expressions (parsing, labelling, safe ratios, hash split)
    operators/  DataFrame -> DataFrame operators (labels, features, star schema,
                audits, split, models, evaluation, report measures)
    plans/      end-to-end jobs (bronze / silver / gold) and the test-data bindings
    streaming/  the same transformations on Structured Streaming

Every operator takes and returns DataFrames and leaves physical planning to
Catalyst and AQE.
"""

__version__ = "0.1.0"
