"""loadkit: metadata-driven batch ingestion and upsert as Spark DataFrame jobs.

Sub-packages:

* ``sources``    delimited, XML and file-listing readers, table access
* ``functions``  column expressions (keys, hashes, globs, numbering)
* ``operators``  conform, change classification, upsert, ledger, audit
* ``plans``      run orchestration, snapshot tables, table creation
* ``streaming``  incremental file ingestion with Structured Streaming
"""

from loadkit.contracts import (  # noqa: F401
    AuditColumns,
    ColumnMap,
    ContractError,
    FeedContract,
    LoadSpec,
    TableDef,
    XmlColumn,
    XmlContract,
    XmlRecordSet,
)

__version__ = "0.1.0"
