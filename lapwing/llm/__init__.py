"""Training-data operators: filtering, deduplication, tokenising, scoring.

Nothing else in :mod:`lapwing` imports this subpackage.
"""
