"""Training-data operators (documents, embeddings). Nothing else in the library imports
this subpackage; ``catalog`` lists its queries."""
