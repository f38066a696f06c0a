"""Operators on text collections and on names: frequencies, matching, packing, mixing, reading level."""
