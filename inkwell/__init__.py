"""inkwell — content and market analytics as Spark DataFrame operators.

Every operator is a plain function ``DataFrame -> DataFrame`` built from
built-in Spark SQL expressions, so Catalyst can prune, push down and
codegen the whole plan.  Sub-packages:

* ``sources``   — readers (whole-text folders, metrics files, rule tables)
* ``functions`` — reusable column expressions (labels, formatting, strip)
* ``operators`` — the set-oriented jobs (market, documents, rules, audience …)
* ``sinks``     — partitioned writers
* ``plans``     — bindings of the operators to the driver tables
* ``streaming`` — incremental ingest with Structured Streaming
"""

__version__ = "0.1.0"
