"""Row-level operators: staging, the unified ledger, categorisation, quality."""
