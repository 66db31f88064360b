"""End-to-end stages made of operators."""
