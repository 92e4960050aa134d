"""Writers and request batches."""
