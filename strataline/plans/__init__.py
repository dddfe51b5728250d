"""The three pipelines as compositions of operators."""
