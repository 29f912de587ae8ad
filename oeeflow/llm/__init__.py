"""Operators of a training-data pipeline: mixing, personal data, packing, quality rules,
fingerprints, web archives, similarity joins, toxicity, licences and language-model scores.

``queries`` holds the registered ``opN_<name>`` queries and their SQL; nothing outside this
package imports it but the entry file and ``corpus_pipeline.py``.
"""
