"""Mining of wiki-style page dumps on Spark: text cleaning, word vectors, link graphs."""
