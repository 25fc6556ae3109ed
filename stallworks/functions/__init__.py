"""Column functions. All of them return built-in Catalyst expressions."""
