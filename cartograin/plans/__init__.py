"""Named analyses built from the operators."""
