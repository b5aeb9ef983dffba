"""Training-data pipeline operators (quality, packing, dedup, LM scoring, chat, tokens, language, PII, decontamination).

Nothing else in the library imports this subpackage; ``registry`` lists its queries.
"""
