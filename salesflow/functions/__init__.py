"""Column-level helpers: cleaning, codecs, framing."""
