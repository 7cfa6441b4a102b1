"""DataFrame -> DataFrame operators; those without an ordering work on batch and streaming input alike."""
