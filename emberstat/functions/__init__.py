"""Column functions (cleanup, labels, dates, rounding, hashing, text
normalisation) and the Snowball English stemmer."""
