"""The flows end to end, composed from the operators."""
