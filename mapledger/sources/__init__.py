"""Reading what the service publishes, and writing results."""
