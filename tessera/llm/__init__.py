"""Training-data operators: fingerprints, near and exact deduplication,
decontamination, chat formatting, tokenization, URL rules, toxicity, language
identification and sharding, each as a Spark job over whole tables."""
