"""DataFrame operators, one module per step of a delivery."""
