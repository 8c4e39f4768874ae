"""Gold dimensions/facts and analytics marts, composed from the operators."""
