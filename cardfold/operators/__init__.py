"""DataFrame operators: pages to tables, tables to clean tables."""
