"""Training-data operators over documents, pages, labels and conversations."""
