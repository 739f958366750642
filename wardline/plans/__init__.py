"""The two study builds, assembled from the operators."""
