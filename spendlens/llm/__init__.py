"""Training-data operators: deduplication, classifiers, decontamination, scoring and mixing."""
