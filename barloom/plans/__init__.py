"""Jobs built from the operators, and the registry of datasets and checks."""
