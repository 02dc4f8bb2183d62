"""Readers and writers for dumps, snapshots and versioned stores."""
