"""Column functions: text cleaning, sentences, tokens, n-grams."""
