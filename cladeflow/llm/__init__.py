"""Training-data operators on the project's tables; nothing outside imports this package."""
