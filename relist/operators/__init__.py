"""DataFrame -> DataFrame operators: extraction, validation, reconciliation, accounting."""
