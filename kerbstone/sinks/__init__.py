"""Where rows go: replay-safe table writes and catalog registration."""
