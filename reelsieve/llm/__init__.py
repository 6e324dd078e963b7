"""Training-data operators: deduplication, filters, scans, tokenization and decontamination of text.

``queries()`` and ``oracle_sql()`` list one query per operator; nothing outside this subpackage imports it
except the guarded registration in the entry module and the corpus pipeline.
"""
