"""Sources: sheet exports, XML documents / JSON envelopes, config tables."""
