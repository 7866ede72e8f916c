"""Operators of a training-data pipeline: language identification, near
duplicates, decontamination, chat formatting, packing, licence scans,
sharding and repeated-passage removal. Nothing outside this package imports
it; ``queries.py`` registers one query for each operator."""
