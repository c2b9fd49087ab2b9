"""ledgerlake: invoice-to-ledger analytics expressed as Spark DataFrame plans.

Layers (each a module of pure ``DataFrame -> DataFrame`` functions):

* ``sources``   – run-folder JSON readers, file manifest, reference data,
                  table sinks, and the mapping of the benchmark tables onto
                  the invoice data model.
* ``functions`` – column expressions (run id, stage, money formatting,
                  JSON extraction) that stay inside whole-stage codegen.
* ``operators`` – bronze / silver / gold / observability tables and the
                  business rules (FX lookup, ledger matching, rule
                  classification, posting and exception queues).
* ``plans``     – the medallion run and the registry of named queries.
* ``streaming`` – incremental bronze ingestion with Structured Streaming.
"""

__version__ = "0.1.0"
