"""Model families, their training and selection, and batch scoring."""
