"""Dataset declarations and the Bronze and Silver layouts."""
