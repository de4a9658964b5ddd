"""Plans over the operators: named queries, catalog DDL/views, layer jobs."""
