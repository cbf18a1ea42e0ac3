"""The three pipelines as plans, and the catalogue of registered queries."""
