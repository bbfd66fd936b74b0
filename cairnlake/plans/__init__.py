"""The silver and gold models and the batch job that runs them."""
