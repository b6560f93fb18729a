"""Readers and writers: ledger tables, blobs, dead letters, bundles and exports."""
