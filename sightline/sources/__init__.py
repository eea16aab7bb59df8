"""Where data comes from and goes to: envelope files, the archive, dead letters, the registry of sources."""
