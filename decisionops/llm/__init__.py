"""Training-data pipeline operators (toxicity, decontamination, language ID,
near-duplicate search, extraction, sharding, chat formatting, packing).

Nothing else in the library imports this subpackage."""
