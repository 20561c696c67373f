"""Input tables for trials: generated rows, injected defects, and the star-schema mapping."""
