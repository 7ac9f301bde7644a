"""Reading snapshots and delimited tables, writing result tables."""
