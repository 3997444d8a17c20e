"""Multi-table plans: dimensional model, cube queries, measures, source merging, ordered steps."""
