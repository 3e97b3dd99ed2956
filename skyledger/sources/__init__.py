"""Source readers: raw feeds to canonical tables, and the registry of sources."""
