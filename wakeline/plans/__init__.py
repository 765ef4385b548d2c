"""Job functions and the registered query catalog."""
