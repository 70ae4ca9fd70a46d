"""reelcat: a PySpark engine for video-metadata catalogs.

Subpackages:

* ``sources``   scans: record dumps, catalogs, manifests, ledgers, media folders, pages
* ``functions`` Column -> Column scalar functions (record grammar, names, numbers, HTML fields)
* ``operators`` DataFrame -> DataFrame operators (parse, dedup, select, manifest, joins, ledger, media, pages)
* ``sinks``     writers (dumps, row-form tables, single-object JSON documents, ledger versions)
* ``plans``     user-level jobs (C1-C8) and the registered queries
* ``streaming`` Structured Streaming forms of ingest and ledger updates
"""

__version__ = "0.1.0"
