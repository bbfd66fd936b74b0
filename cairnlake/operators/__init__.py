"""DataFrame -> DataFrame operators shared by the models."""
