"""Training-data operators: WARC, BPE, top-k, Jaccard join, decontamination, line dedup, PII,
toxicity, licences and URL filters. Nothing else in the library imports this subpackage."""
