"""Writers for files, documents, batches and landing zones."""
