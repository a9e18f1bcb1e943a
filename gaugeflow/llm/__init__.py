"""Operators for preparing large text corpora: language identification,
decontamination, archives, line and substring de-duplication, packing, chat
formatting, quality rules, near-duplicates and page extraction.

Nothing else in the package imports this subpackage; ``__spark_entry__``
adds its queries only when it can be imported.
"""
