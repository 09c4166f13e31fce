"""Training-data pipeline operators: formatting, packing, counting, filtering and de-duplication of documents."""
