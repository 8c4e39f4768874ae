"""Sources: file ingest, audit columns, payload flattening, test-table views."""
