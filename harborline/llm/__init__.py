"""Operators for preparing training data: quality, near copies, packing, decontamination, toxicity and the like."""
