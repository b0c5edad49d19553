"""Row-local features on streams of transactions."""
