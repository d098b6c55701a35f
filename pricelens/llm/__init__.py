"""Training-data pipeline operators: decontamination, language ID, fingerprints, mixing,
WARC archives, near-duplicate removal, classifiers, page extraction and sharding.

Nothing else in the library imports this subpackage."""
