"""Frame-level operators: validation, ledgers, lookups, new-row detection, metrics."""
