"""Clusters, embeddings and predictive models."""
