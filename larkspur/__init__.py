"""DataFrame operators for customer features, model scoring, text retrieval and message routing."""
