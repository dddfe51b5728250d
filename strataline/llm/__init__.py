"""Operators a training-data pipeline needs: packing, deduplication, search, language, extraction, licences, mixing."""
