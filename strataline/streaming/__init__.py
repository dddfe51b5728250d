"""Incremental discovery of new deliveries."""
