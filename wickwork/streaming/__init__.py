"""The candle event stream: parsing, dead letters, and streaming tables."""
