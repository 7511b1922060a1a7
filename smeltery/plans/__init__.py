"""Work lists, layer runs and the Gold models."""
