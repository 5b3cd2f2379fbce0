"""DataFrame operators over records, texts and paths."""
