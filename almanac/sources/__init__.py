"""Reading and writing: station registry, API payloads, bronze lake, model tables."""
