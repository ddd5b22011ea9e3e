"""Training-data operators: text scoring, decontamination, near duplicates,
line dedup, chat formatting, token counts, language ID, packing, hard
negatives, page text and the audit of sources."""
