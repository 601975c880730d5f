"""Jobs and query plans composed from the operators."""
