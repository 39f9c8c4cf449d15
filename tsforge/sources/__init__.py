"""What the engine reads: line protocol, fact tables, index dumps, backup manifests."""
