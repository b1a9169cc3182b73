"""Training-data operators: packing, near-duplicates, filters, sharding, token files.

Each module holds one operator with its own general interface; ``queries`` maps
the operators onto the driver's tables.  Nothing outside this package imports it.
"""
