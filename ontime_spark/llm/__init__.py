"""Training-data operators: scoring, extraction, deduplication, language, archives, quality,
tokenisation, licences and decontamination over the document and page tables.

Nothing else in the library imports this subpackage. ``registry.QUERIES`` and ``registry.SQL``
list the registered queries."""
