"""Training-data operators: ten corpus-scale operators over documents,
conversations and embeddings. Nothing outside this package imports it; the
query registry picks it up only when it is present."""
