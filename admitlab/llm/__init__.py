"""Training-data operators: tokens, scoring, de-duplication, filters, mixing."""
