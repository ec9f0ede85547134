"""Operators of a training-data pipeline: mixing, token files, quality rules,
decontamination, language-model scores, personal data, near duplicates, a
quality classifier, sharding and chat formatting. Nothing else in the library
imports this subpackage."""
