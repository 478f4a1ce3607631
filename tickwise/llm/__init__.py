"""Training-data operators: extraction, language, licences, packing, search,
personal data, decontamination, sharding, near duplicates, coded token files.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its
queries only where the package is present.
"""
