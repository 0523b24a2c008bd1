"""End-to-end flows composed of the operators; each is one lazy plan between its tables."""
