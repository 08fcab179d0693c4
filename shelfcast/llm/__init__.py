"""Training-data operators: near duplicates, packing, classifiers, language models, tokens."""
