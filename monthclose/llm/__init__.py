"""Training-data operators: scans, classifiers, duplicate search, counts, mixing, packing. Nothing else imports this."""
