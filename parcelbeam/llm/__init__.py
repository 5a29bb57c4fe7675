"""Operators for preparing large text corpora: quality, near duplicates, packing,
secrets, passages, toxicity, search, language models, mixing and token counts.

Nothing outside this subpackage imports it."""
