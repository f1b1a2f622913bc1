"""lakestrata: layered data-lake table operators on the public PySpark DataFrame API.

Modules:
    sources    Parquet/CSV/JSON/XML/JDBC readers, lake layout, file selection, snapshots
    functions  column expressions (time parsing, day counts, string cleaning, null-likes)
    operators  transforms, relational operators, data-quality reports
    plans      stalled-case facts and layer-to-layer pipelines
    sinks      Parquet/JSON/CSV/XML/Delta/JDBC writers
    streaming  incremental standardization as a file-source stream
"""

__version__ = "0.1.0"
