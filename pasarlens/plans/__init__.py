"""Reports, features and models built from the operators."""
