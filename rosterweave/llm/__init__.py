"""Operators for training data about people: matching, mapping, grouping, packing, mixing."""
