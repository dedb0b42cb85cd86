"""Training-data operators: decontamination, mixing, quality, dedup, language, secrets, HTML.

Nothing outside this subpackage imports it. ``queries.py`` registers one query per operator.
"""
