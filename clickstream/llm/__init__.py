"""Training-data pipeline operators (ten) and their queries; nothing else in the library imports this package."""
