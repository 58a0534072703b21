"""Tessera: pairwise record analytics as composable Spark DataFrame operators."""
