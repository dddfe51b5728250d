"""The operators bound to the driver's test tables, each with an independent SQL form."""
