"""Column builders: text rules, keyed hashing and sealing, request headers, devices, metadata."""
