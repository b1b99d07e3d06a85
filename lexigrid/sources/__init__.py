"""Reading corpora and writing results."""
