"""Column functions shared by the operators and plans."""
