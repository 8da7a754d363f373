"""Training-data operators: mixing, scanning, scoring, deduplication and tokenisation of document tables."""
