"""ticketlens: point-in-time ticket histories, lead-time labels, features, models and trust scores on Spark."""

__version__ = "0.1.0"
