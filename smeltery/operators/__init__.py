"""DataFrame operators of the Bronze, Silver and Gold layers."""
