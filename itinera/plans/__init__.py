"""End-to-end business plans composed from the operators."""
