"""Training-data operators: quality, line dedup, token counts, toxicity, chat formatting, near-duplicates of
vectors and texts, HTML extraction, benchmark decontamination and sequence packing.

Nothing else in the library imports this subpackage; ``queries.py`` names its registered queries.
"""
