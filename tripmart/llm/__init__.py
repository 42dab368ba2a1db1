"""Operators for large text corpora: licence scans, exact and near
deduplication, personal data, decontamination, packing, HTML text, nearest
neighbours and language identification. Nothing else in the package imports
this subpackage."""
