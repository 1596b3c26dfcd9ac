"""Compositions of operators: preprocessing and the training stages."""
