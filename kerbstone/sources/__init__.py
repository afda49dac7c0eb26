"""Where rows come from: streams of messages or tables, and the test-table feed."""
