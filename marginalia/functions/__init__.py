"""Column expressions: wikitext cleaning, link extraction, tokens, vector arithmetic."""
