"""Training-data operators: archives, language, quality, dedup, decontamination, packing.

Nothing else in the package imports this subpackage.  Operators live one per
module; ``queries`` registers the thin queries over the given tables.
"""
