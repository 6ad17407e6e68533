"""Operators of a training-data pipeline: tokenising, filtering, de-duplication,
masking, mixing, scoring and binary output of a corpus of documents. Each module
holds one operator; nothing else in the package imports this subpackage."""
